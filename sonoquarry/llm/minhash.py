"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard verification.

A document's set holds its distinct shingles of `shingle` words. One permutation scatters the shingles over a
circle of 2^20 places, a second one numbers the places, and coordinate k of the signature is the
smallest number met when the numbering is turned by k places: two permutations give all coordinates.

Equal sets collapse into classes before anything else, so exact copies cost one row each. Bands of
the signatures put class representatives into buckets. Within a bucket each member is compared with
the bucket's smallest member only, never with all others. Components of the confirmed links show
which buckets still hold unlinked members; those (and only those) are compared with the bucket's
other members, in blocks of bounded size, where one matrix product gives all intersections of a
block and only links leave the task. Every link is confirmed on full sets.

Defined results: a null doc_id is returned with null component and kept = false; null, empty and
blank texts have no shingles and link with nothing; a text shorter than a shingle is one shingle; repeated rows each
return a row, and all rows of one doc_id with equal texts get the same component; an empty table
returns an empty table. Columns other than the id and the text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sonoquarry.llm import textbytes as tb
from sonoquarry.llm.shared import components, documents_of, filtered_rows, release, saved

SHINGLE = 2  # words
ROWS, BANDS = 5, 40  # a pair at 0.8 shares a band with probability 1 - 1.3e-7
_PLACES = 1 << 20
_SEED = 20_240_607
_NOT_SPACE = ~tb.class_table((0x09, 0x0D), (0x20, 0x20))
SIEVE_BITS = 1 << 26
_SQUARE = 256  # members a side in a block of comparisons
_WIDTH = 8192  # shingles of a block that are compared at once


@lru_cache(maxsize=2)
def _windows(k: int) -> np.ndarray:
    """Row p holds the numbers of places p, p+1, ... p+k-1 on the circle."""
    number = np.random.default_rng(_SEED).permutation(_PLACES).astype(np.uint32)
    return np.lib.stride_tricks.sliding_window_view(np.concatenate([number, number[: k - 1]]), k)


def shingle_sets(column: pa.Array, shingle: int = SHINGLE) -> Iterator[np.ndarray]:
    """For each text, the sorted distinct 64-bit codes of its shingles of so many words."""
    data, offsets = tb.column_bytes(column)
    none = np.zeros(0, np.uint64)
    for a, b in tb.slices(offsets):
        buf = tb.LOWER[data[offsets[a] : offsets[b]]]
        starts, ends, first = tb.word_spans(buf, offsets[a : b + 1] - offsets[a], _NOT_SPACE)
        words = tb.word_hashes(buf, starts, ends)
        runs = [words]  # runs[m][i]: code of the m + 1 words from word i on
        for m in range(1, shingle):
            runs.append(tb.mix(runs[-1][:-1] * np.uint64(0x9E3779B97F4A7C15) + words[m:]))
        for i, j in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            n = min(shingle, j - i)
            yield none if n == 0 else tb.mix(words[i:j]) if j - i == 1 else np.unique(runs[n - 1][i : j - n + 1])


def signature(codes: np.ndarray, k: int) -> np.ndarray:
    """Circulant MinHash of a non-empty set: k coordinates."""
    windows, place = _windows(k), (codes >> np.uint64(44)).astype(np.int64)
    out = windows[place[:1024]].min(axis=0)
    for a in range(1024, len(place), 1024):
        np.minimum(out, windows[place[a : a + 1024]].min(axis=0), out=out)
    return out


def band_keys(coordinates: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A 64-bit key for each band of a signature; keys of different bands don't meet."""
    key = tb.mix(np.arange(1, bands + 1, dtype=np.uint64))
    for column in coordinates.reshape(bands, rows).T.astype(np.uint64):
        key = tb.mix(key * np.uint64(0x9E3779B97F4A7C15) + column)
    return key


def _lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    offsets = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(x) for x in arrays], out=offsets[1:])
    values = np.concatenate(arrays) if arrays else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64), type=kind))


def _signed(bands: int, rows: int, shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.uint64)
        for batch in (whole.slice(a, 2048) for whole in batches for a in range(0, whole.num_rows, 2048)):
            sizes, marks, keys = [], [], []
            for codes in shingle_sets(batch.column("text"), shingle):
                sizes.append(len(codes))
                marks.append(hashlib.blake2b(codes.tobytes(), digest_size=16).digest() if len(codes) else None)
                keys.append(band_keys(signature(codes, bands * rows), bands, rows) if len(codes) else none)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(marks, pa.binary()), _lists(keys, pa.int64())], names=["doc_id", "n", "mark", "keys"])
        release()

    return run


def _sieve_places(ids: np.ndarray, size: int) -> np.ndarray:
    ids = ids.astype(np.int64).view(np.uint64)
    return np.stack([tb.mix(ids + np.uint64(k) * np.uint64(0xD6E8FEB86659FD93)) % np.uint64(size) for k in range(1, 5)]).astype(np.int64)


def _sieve(ids: DataFrame) -> np.ndarray:
    """A Bloom filter of ids, of SIEVE_BITS at most: only a shortcut before an exact join."""
    size = int(min(SIEVE_BITS, max(1 << 12, 12 * ids.count())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(size, bool)
        for batch in batches:
            bits[_sieve_places(batch.column(0).to_numpy(), size)] = True
        yield pa.RecordBatch.from_arrays([pa.array([np.packbits(bits).tobytes()], pa.binary())], names=["bits"])

    parts = ids.coalesce(4).mapInArrow(run, "bits binary").toLocalIterator()
    total = np.zeros(size, bool)
    for row in parts:
        total |= np.unpackbits(np.frombuffer(row.bits, np.uint8), count=size).astype(bool)
    return total


def _sets_of(shared, shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sieve = shared.value
        for batch in batches:
            hit = sieve[_sieve_places(batch.column("doc_id").to_numpy(), len(sieve))].all(axis=0)
            yield from _sets(batch.filter(pa.array(hit)), shingle)

    return run


def _sets(batch: pa.RecordBatch, shingle: int) -> Iterator[pa.RecordBatch]:
    for a in range(0, batch.num_rows, 1024):
        part = batch.slice(a, 1024)
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), _lists(list(shingle_sets(part.column("text"), shingle)), pa.int64())], names=["doc_id", "codes"])


def _entries(sets: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """Row number and code of every member of the sets."""
    return np.repeat(np.arange(len(sets)), sets.map(len).to_numpy()), np.concatenate(sets.tolist())


def _columns(entries: tuple[np.ndarray, np.ndarray], known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the entries whose code is known, by column."""
    if not len(known):
        return entries[0][:0], entries[1][:0]
    at = np.minimum(np.searchsorted(known, entries[1]), len(known) - 1)
    hit = known[at] == entries[1]
    rows, at = entries[0][hit], at[hit]
    order = np.argsort(at, kind="stable")
    return rows[order], at[order]


def _dense(entries: tuple[np.ndarray, np.ndarray], start: int, rows: int) -> np.ndarray:
    a, b = np.searchsorted(entries[1], [start, start + _WIDTH])
    out = np.zeros((rows, _WIDTH), np.float32)
    out[entries[0][a:b], entries[1][a:b] - start] = 1
    return out


def _compare(percent: int):
    """Links between the block's open members and its members, one per open member and component."""

    def run(block: pd.DataFrame) -> pd.DataFrame:
        left, right = block[block["open"]], block[~block["open"]]
        if left.empty or right.empty:
            return pd.DataFrame({"a": pd.Series(dtype="int64"), "b": pd.Series(dtype="int64")})
        n_left, n_right = left["codes"].map(len).to_numpy(), right["codes"].map(len).to_numpy()
        x, y = _entries(left["codes"]), _entries(right["codes"])
        known = np.intersect1d(x[1], y[1])
        shared = np.zeros((len(left), len(right)), np.float32)
        x, y = _columns(x, known), _columns(y, known)
        for a in range(0, len(known), _WIDTH):  # a bounded part of the columns at a time
            shared += _dense(x, a, len(left)) @ _dense(y, a, len(right)).T
        shared = np.rint(shared).astype(np.int64)
        linked = 100 * shared >= percent * (n_left[:, None] + n_right[None, :] - shared)
        home_left, home_right = left["home"].to_numpy(), right["home"].to_numpy()
        linked &= home_left[:, None] != home_right[None, :]
        i, j = np.nonzero(linked)
        return pd.DataFrame({"a": home_left[i], "b": home_right[j]}).drop_duplicates()

    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80, bands: int = BANDS, rows: int = ROWS, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable over links), kept (doc_id = component_id).

    Two documents are linked if 100 * intersection >= percent * union of their shingle sets.
    """
    docs = documents_of(docs, id_col, text_col)
    signed = saved(docs.mapInArrow(_signed(bands, rows, shingle), "doc_id long, n long, mark binary, keys array<long>"))
    full = signed.where("doc_id is not null and n > 0")
    classes = full.groupBy("mark").agg(F.min("doc_id").alias("rep"))
    filed = signed.select("doc_id", "n", F.when(F.col("doc_id").isNotNull(), F.col("mark")).alias("mark")).join(classes, "mark", "left")
    # A class of one needs no partner to be a representative; a larger one is represented by its smallest doc_id.
    reps = full.join(classes.withColumnRenamed("rep", "doc_id"), ["mark", "doc_id"], "left_semi").select("doc_id", F.explode("keys").alias("key"))
    hubs = reps.groupBy("key").agg(F.min("doc_id").alias("hub"), F.max("doc_id").alias("last")).where("hub < last").drop("last")
    stars = saved(reps.join(hubs, "key").where("doc_id <> hub").select("hub", "doc_id").distinct())
    ids = saved(stars.select("doc_id").unionByName(stars.select(F.col("hub").alias("doc_id"))).distinct())
    # Texts are not shuffled: a sieve leaves hardly more than the documents wanted, whose sets are then joined.
    sieve = docs.sparkSession.sparkContext.broadcast(_sieve(ids))
    sets = saved(docs.where("doc_id is not null").mapInArrow(_sets_of(sieve, shingle), "doc_id long, codes array<long>").join(ids, "doc_id", "left_semi"))
    of = lambda name: sets.select(F.col("doc_id").alias(name), F.col("codes").alias(f"{name}_codes"))
    shared = F.size(F.array_intersect("a_codes", "b_codes"))
    pairs = stars.select(F.col("hub").alias("a"), F.col("doc_id").alias("b")).join(of("b"), "b").join(of("a"), "a")
    first = saved(pairs.withColumn("i", shared).where(F.expr(f"100L * i >= {percent}L * (size(a_codes) + size(b_codes) - i)")).select("a", "b").distinct())
    homes = components(first)
    second = _open_links(stars, homes, sets, percent)
    labels = components(first.unionByName(second)) if second is not None else homes
    out = filed.join(labels.select(F.col("node").alias("rep"), "component"), "rep", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80, shingle: int = SHINGLE) -> DataFrame:
    """docs, with all their columns, without documents that are not their group's smallest doc_id.

    Of rows that repeat both doc_id and text one stays; rows without a doc_id all stay. Texts of
    documents that a sieve shows to stay are not shuffled; the rest is decided by an exact join.
    """
    names = docs.columns
    found = near_duplicates(docs, id_col, text_col, percent, shingle=shingle).where("doc_id is not null")
    decided = found.groupBy("doc_id").agg(F.max("kept").alias("kept"), F.count("*").alias("n")).where("not kept or n > 1")
    decided = saved(decided)
    sieve = docs.sparkSession.sparkContext.broadcast(_sieve(decided.select("doc_id")))

    def hit(batch: pa.RecordBatch) -> np.ndarray:
        ids = batch.column("doc_id")
        return sieve.value[_sieve_places(ids.fill_null(0).to_numpy(), len(sieve.value))].all(axis=0) & ids.is_valid().to_numpy(zero_copy_only=False)

    plain = filtered_rows(docs, lambda batch: ~hit(batch), id_col, text_col)
    maybe = filtered_rows(docs, hit, id_col, text_col).toDF(*[f"c{k}" for k in range(len(names))])
    key = f"c{names.index(id_col)}"
    joined = maybe.join(decided.withColumnRenamed("doc_id", key), key, "left").where("kept is null or kept")
    single = joined.where("n is null or n = 1").select(*maybe.columns)
    repeated = joined.where("n > 1").select(*maybe.columns).dropDuplicates([key, f"c{names.index(text_col)}"])
    return plain.unionByName(single.toDF(*names)).unionByName(repeated.toDF(*names))


def _open_links(stars: DataFrame, homes: DataFrame, sets: DataFrame, percent: int) -> DataFrame | None:
    """Links that no star has shown: between members of one bucket that lie in different components.

    A group is what shares a bucket's smallest member. Where all of it is one component nothing is
    left to find. Else the members outside its commonest component are compared with all members.
    """
    member = stars.select("hub", "doc_id").unionByName(stars.select("hub", F.col("hub").alias("doc_id")).distinct())
    member = member.join(homes.select(F.col("node").alias("doc_id"), "component"), "doc_id", "left").select("hub", "doc_id", F.coalesce("component", "doc_id").alias("home"))
    sizes = member.groupBy("hub", "home").agg(F.count("*").alias("size"))
    groups = sizes.groupBy("hub").agg(F.sum("size").alias("size"), F.expr("max_by(home, struct(size, home))").alias("main"), F.max("size").alias("most")).where("size > 2 and most < size")
    member = saved(member.join(groups, "hub"))
    if member.isEmpty():
        return None
    # Blocks: `open` members dealt over `across`, all members over `down`; a pair meets in one block.
    member = member.withColumn("across", F.ceil((F.col("size") - F.col("most")) / _SQUARE)).withColumn("down", F.ceil(F.col("size") / _SQUARE))
    at = lambda n, seed: F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.col(n)).cast("long")
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), (F.col(n) - 1).cast("long")))
    left = member.where("home <> main").select("hub", "doc_id", "home", F.lit(True).alias("open"), at("across", 1).alias("i"), every("down").alias("j"))
    right = member.select("hub", "doc_id", "home", F.lit(False).alias("open"), at("down", 2).alias("j"), every("across").alias("i"))
    blocks = left.unionByName(right).join(sets, "doc_id")
    return saved(blocks.groupBy("hub", "i", "j").applyInPandas(_compare(percent), "a long, b long").distinct())
