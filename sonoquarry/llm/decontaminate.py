"""Benchmark decontamination by a prefix-filtered set join over item-sized windows.

A benchmark item gives windows of 10 consecutive words; a shorter item is one window. A window can
occur in a document only if all its 3-word shingles do, so its necessary prefix is one shingle: the
rarest one, by counts over all documents. The document side joins its shingles with those prefixes
only; a meeting gives the one position at which the window could stand (positional bound), which must
fit into the document (length bound), and then every word of the window is compared.

The prefix index of a block of items is broadcast: arrays of some 34 bytes a word, no object a window, so a
block of BLOCK_BYTES of text takes about 6 times that in each worker. A larger benchmark makes more blocks
(items are dealt by a hash of id and text), handled one after the other, each index given up before the next
is made; their hits are merged by document. Nothing is dropped and nothing grows with the benchmark but
the number of scans, two a block. Texts are never shuffled and no key is special, however often a
passage occurs.

Defined results: null, empty and wordless texts have no words and no hits; items without words never
occur; repeated item_ids count once; null item_ids hit words but are not listed; an empty benchmark
hits nothing; repeated documents each return a row. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sonoquarry.llm import textbytes as tb
from sonoquarry.llm.shared import documents_of, filtered_rows
from sonoquarry.storage import saved

WINDOW, SHINGLE = 10, 3
BLOCK_BYTES = 8 << 20  # text of the items of one block
_WORD = tb.class_table((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
_C = np.uint64(0x9E3779B97F4A7C15)


def tokenised(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Word codes of a slice of rows, and each row's first word (one entry more than rows)."""
    data, offsets = tb.column_bytes(column)
    for a, b in tb.slices(offsets):
        buf = tb.LOWER[data[offsets[a] : offsets[b]]]
        starts, ends, first = tb.word_spans(buf, offsets[a : b + 1] - offsets[a], _WORD)
        yield tb.word_hashes(buf, starts, ends), first


def _shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Codes of all runs of `size` words, at the run's first word."""
    n = max(0, len(words) - size + 1)
    out = np.full(n, size, dtype=np.uint64)
    for k in range(size):
        out = tb.mix(out * _C + words[k : k + n])
    return out


class Windows:
    """Windows of a block of items, each filed under its rarest shingle."""

    def __init__(self, ids: list, texts: list[str | None], window: int = WINDOW) -> None:
        self.items = [i for i in dict.fromkeys(ids) if i is not None]
        number = {i: k for k, i in enumerate(self.items)} | {None: -1}
        words, sizes = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for codes, first in tokenised(pa.array(texts, pa.string())):
            words.append(codes)
            sizes.append(np.diff(first))
        self.flat, size = np.concatenate(words), np.concatenate(sizes)
        first = np.cumsum(size) - size
        n = np.where(size > 0, np.maximum(1, size - window + 1), 0)  # windows of an item
        row = np.repeat(np.arange(len(size)), n)
        self.at = np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        self.length = np.minimum(size[row], window).astype(np.int16)
        self.owner = np.array([number[i] for i in ids], np.int32)[row]
        self.sizes = np.unique(np.minimum(SHINGLE, self.length)).tolist()
        # Shingles that run over an item's end are counted too, but belong to no window.
        self.codes = {z: np.unique(_shingles(self.flat, z)) for z in self.sizes}

    def count(self, words: np.ndarray, first: np.ndarray, totals: dict[int, np.ndarray]) -> None:
        """Add the occurrences of this block's shingles in a slice of documents."""
        for z, known in self.codes.items():
            at = _found(_inside(words, first, z)[0], known)[1]
            totals[z] += np.bincount(at, minlength=len(known))

    def rank(self, totals: dict[int, np.ndarray]) -> None:
        """Order the shingles by rarity and keep of each window only its rarest as its prefix."""
        self.prefix = {}
        for z in self.sizes:
            codes = _shingles(self.flat, z)
            rarity = totals[z][np.searchsorted(self.codes[z], codes)]
            offset = np.zeros(len(self.at), np.int16)
            for size in np.unique(self.length[np.minimum(SHINGLE, self.length) == z]).tolist():
                seen = np.lib.stride_tricks.sliding_window_view(rarity, size - z + 1)
                mine = np.flatnonzero(self.length == size)
                for a in range(0, len(mine), 1 << 16):
                    offset[mine[a : a + (1 << 16)]] = seen[self.at[mine[a : a + (1 << 16)]]].argmin(axis=1)
            mine = np.flatnonzero(np.minimum(SHINGLE, self.length) == z)
            filed = codes[self.at[mine] + offset[mine]]
            order = np.argsort(filed, kind="stable")
            keys, start = np.unique(filed[order], return_index=True)
            self.prefix[z] = (keys, np.append(start, len(order)), mine[order].astype(np.int32), offset[mine[order]])
        self.at = self.at.astype(np.int32)
        self.codes = {}

    def hits(self, words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Window numbers that occur and the words at which they begin, over a slice of documents."""
        found, begins = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for z, (keys, start, window, offset) in self.prefix.items():
            codes, place = _inside(words, first, z)
            where, key = _found(codes, keys)
            many = start[key + 1] - start[key]
            entry = np.repeat(start[key], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            begin = np.repeat(place[where], many) - offset[entry]
            k = window[entry]
            row = np.repeat(np.searchsorted(first, place[where], side="right") - 1, many)
            fits = (begin >= first[row]) & (begin + self.length[k] <= first[row + 1])
            begin, k = begin[fits], k[fits]
            for j in range(int(self.length.max(initial=0))):
                live = self.length[k] > j
                same = ~live
                same[live] = words[begin[live] + j] == self.flat[self.at[k[live]] + j]
                begin, k = begin[same], k[same]
            found.append(k)
            begins.append(begin)
        return np.concatenate(found), np.concatenate(begins)


def _inside(words: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that lie within one row, and their places."""
    codes = _shingles(words, size)
    ok = np.ones(len(codes), bool)
    for k in range(1, size):
        edge = first[1:-1] - k
        ok[edge[(edge >= 0) & (edge < len(ok))]] = False
    place = np.flatnonzero(ok)
    return codes[place], place


def _found(codes: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the codes that are known, and where in the sorted known codes they stand."""
    if not len(known) or not len(codes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    gate = np.zeros(1 << 16, bool)
    gate[(known >> np.uint64(48)).astype(np.int64)] = True
    maybe = np.flatnonzero(gate[(codes >> np.uint64(48)).astype(np.int64)])
    at = np.minimum(np.searchsorted(known, codes[maybe]), len(known) - 1)
    hit = known[at] == codes[maybe]
    return maybe[hit], at[hit]


def _indexes(docs: DataFrame, benchmark: DataFrame, window: int, block_bytes: int) -> Iterator:
    """The broadcast index of one block of the benchmark after the other, prefixes chosen by counts over all docs."""
    items = benchmark.select(F.col("item_id"), F.col("text").cast("string").alias("text")).where("text is not null").distinct()
    context = docs.sparkSession.sparkContext
    n = _block_count(benchmark, block_bytes)
    for k in range(n):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k) if n > 1 else items
        rows = part.orderBy("item_id", "text").collect()
        index = Windows([r[0] for r in rows], [r[1] for r in rows], window)
        if not len(index.at):
            continue
        totals = {z: np.zeros(len(known), np.int64) for z, known in index.codes.items()}
        raw = context.broadcast(index)
        counts = docs.select("text").mapInArrow(_counted(raw), "z long, k long, n long").groupBy("z", "k").agg(F.sum("n").alias("n"))
        for z, place, count in counts.collect():  # as many as the block has shingles, at most
            totals[z][place] = count
        raw.unpersist()
        index.rank(totals)
        yield context.broadcast(index)


def _block_count(benchmark: DataFrame, block_bytes: int) -> int:
    size = benchmark.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    return -(-size // block_bytes)


def _counted(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        totals = {z: np.zeros(len(known), np.int64) for z, known in index.codes.items()}
        for batch in batches:
            for words, first in tokenised(batch.column("text")):
                index.count(words, first, totals)
        for z, n in totals.items():
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), z)), pa.array(some), pa.array(n[some])], names=["z", "k", "n"])

    return run


def _per_document(index: Windows, column: pa.Array) -> Iterator[tuple[int, list, set]]:
    """Of each text: its words, the (begin, end) of all windows in it, and the items they come from."""
    for words, first in tokenised(column):
        window, begin = index.hits(words, first)
        rows = np.searchsorted(first, begin, side="right") - 1
        order = np.argsort(rows, kind="stable")
        window, begin, rows = window[order], begin[order] - first[rows[order]], rows[order]
        edges = np.searchsorted(rows, np.arange(len(first)))
        for k, n in enumerate(np.diff(first).tolist()):
            a, b = edges[k], edges[k + 1]
            if a == b:
                yield n, [], set()
                continue
            spans = np.unique(np.stack([begin[a:b], begin[a:b] + index.length[window[a:b]]], axis=1), axis=0)
            yield n, spans.tolist(), {index.items[x] for x in np.unique(index.owner[window[a:b]]).tolist() if x >= 0}


def _covered(spans: list) -> int:
    """Places inside any of the sorted spans."""
    total, end = 0, 0
    for a, b in spans:
        if b > end:
            total, end = total + b - max(a, end), b
    return total


def _digest(items: set) -> str:
    return hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()


def _marked(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(n, _covered(spans), len(items), _digest(items)) for n, spans, items in _per_document(shared.value, batch.column("text"))]
            n_words, n_hit, n_items, sums = zip(*rows, strict=True) if rows else ([], [], [], [])
            columns = [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(n_items, pa.int64()), pa.array(sums, pa.string()), pa.array([n > 0 for n in n_hit], pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])

    return run


_HITS = "doc_id long, mark binary, spans array<struct<a: int, b: int>>, items array<string>"


def _marks(column: pa.Array) -> list[bytes]:
    return [hashlib.blake2b((t or "").encode("utf-8", "surrogatepass"), digest_size=16).digest() for t in column.to_pylist()]


def _hits_of(shared):
    """Documents with windows of one block, by id and a digest of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(k, spans, items) for k, (_, spans, items) in enumerate(_per_document(shared.value, batch.column("text"))) if spans]
            part = batch.take(pa.array([k for k, _, _ in found], pa.int64()))
            spans = pa.array([[{"a": a, "b": b} for a, b in x] for _, x, _ in found], pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])))
            items = pa.array([sorted(map(str, x)) for _, _, x in found], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(_marks(part.column("text")), pa.binary()), spans, items], names=["doc_id", "mark", "spans", "items"])

    return run


def _words_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = np.concatenate([np.zeros(0, np.int64), *(np.diff(first) for _, first in tokenised(batch.column("text")))])
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(_marks(batch.column("text")), pa.binary()), pa.array(n)], names=["doc_id", "mark", "n_words"])


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_hit = [_covered(sorted((x["a"], x["b"]) for x in spans)) for spans in batch.column("spans").to_pylist()]
        items = [set(x) for x in batch.column("items").to_pylist()]
        columns = [batch.column("doc_id"), batch.column("mark"), pa.array(n_hit, pa.int64()), pa.array([len(x) for x in items], pa.int64()), pa.array([_digest(x) for x in items], pa.string())]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "mark", "n_hit", "n_items", "items_sha256"])


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows, with all their columns, in which no benchmark window occurs."""
    more = _block_count(benchmark, block_bytes) > 1
    for shared in _indexes(documents_of(docs, id_col, text_col), benchmark, window, block_bytes):

        def keep(batch: pa.RecordBatch, shared=shared) -> np.ndarray:
            out, row = np.ones(batch.num_rows, bool), 0
            for words, first in tokenised(batch.column("text")):
                begin = shared.value.hits(words, first)[1]
                out[row + np.searchsorted(first, begin, side="right") - 1] = False
                row += len(first) - 1
            return out

        docs = filtered_rows(docs, keep, id_col, text_col)
        if more:  # what is left is written, so that the block's index can go
            docs = saved(docs)
            shared.unpersist()
    return docs


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    docs = documents_of(docs, id_col, text_col)
    schema = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
    if _block_count(benchmark, block_bytes) <= 1:
        for shared in _indexes(docs, benchmark, window, block_bytes):
            return docs.mapInArrow(_marked(shared), schema)
    hits = docs.sparkSession.createDataFrame([], _HITS)
    for shared in _indexes(docs, benchmark, window, block_bytes):
        hits = hits.unionByName(saved(docs.mapInArrow(_hits_of(shared), _HITS).dropDuplicates(["doc_id", "mark"])))
        shared.unpersist()
    whole = hits.groupBy("doc_id", "mark").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items"))
    whole = whole.mapInArrow(_merged, "doc_id long, mark binary, n_hit long, n_items long, items_sha256 string").alias("h")
    words = docs.mapInArrow(_words_of, "doc_id long, mark binary, n_words long").alias("w")
    joined = words.join(whole, F.expr("w.doc_id <=> h.doc_id and w.mark = h.mark"), "left")
    zero = F.lit(0).cast("long")
    return joined.select("w.doc_id", "n_words", F.coalesce("n_hit", zero).alias("n_hit"), F.coalesce("n_items", zero).alias("n_items"), F.coalesce("items_sha256", F.lit(_digest(set()))).alias("items_sha256"), F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"))
