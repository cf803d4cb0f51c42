"""Language identification by cross-parsing against suffix automata.

For each labelled language a suffix automaton holds a bounded sample of its text. A document is parsed
against it from left to right into the longest phrases that occur in the sample; the fewer phrases a
language needs, the closer the text. Phrases are counted per byte of normalised text, and the language
with the fewest wins; ties go to the smaller name.

Texts are lower-cased and all but letters becomes single spaces; the UTF-8 bytes are parsed. They are
cut into blocks of BLOCK bytes, so that numpy walks the blocks of many texts and all languages at once,
one byte a step; a cut adds one phrase at most. Whole texts are parsed.

The sample, whose sizes are the operator's bounds for fitting: each language's labelled documents are dealt by a
hash of their ids over DRAWS places, of which each gives the document with the smallest hashed id (a grouped
minimum, whatever a language's share of the rows); of these, DOCS documents with the smallest hashed ids are
read, by at most SHARE bytes of normalised text each, until SAMPLE bytes are together. All languages
together have SAMPLES bytes at most, so more than SAMPLES / SAMPLE of them get less each; memory of the
automata follows from that. More than LABELS labels are refused, as no column of languages has so many.
score = 1 - best / second best phrase count, 0 for ties.

in_known_language keeps the texts that learned languages fit: those whose phrases, each block parsed against
its best language, less one for each block, are at most FIT a byte plus SLACK. So texts of several learned
languages stay; SLACK spares short texts, which are too short to tell.

Defined results: null texts and texts without any letter give `und` and score 0; without any labelled
text all give `und`; with one language all lettered texts get it with score 1; null lang is no label;
repeated rows each return a row; an empty table returns an empty table. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sonoquarry.llm.shared import documents_of, filtered_rows

SAMPLE, DOCS, BLOCK = 16_000, 64, 512
SHARE, DRAWS, SAMPLES, LABELS = 2000, 256, 1 << 20, 2000
FIT, SLACK = 0.32, 8
_LETTER = re.compile(r"[^\W\d_]")
_OTHER = re.compile(r"[\W\d_]+")
_LANES = 1 << 17


def normalised(text: str) -> bytes:
    """Lower-case letters with one space for whatever lies between."""
    return _OTHER.sub(" ", text.lower()).strip().encode("utf-8", "replace")


class Automata:
    """Suffix automata of some byte strings over a common alphabet, as one table of transitions.

    State 0 is dead. delta[state * width + symbol] is the next state; root[language] its first state.
    """

    def __init__(self, samples: dict[str, bytes]) -> None:
        self.languages = sorted(samples)
        used = sorted(set(b"".join(samples.values())))
        self.symbol = np.zeros(256, np.int32)  # 0: a byte no sample has
        self.symbol[used] = np.arange(1, len(used) + 1)
        self.width = len(used) + 1
        tables, roots, size = [np.zeros((1, self.width), np.int32)], [], 1
        for name in self.languages:
            table = self._automaton(self.symbol[np.frombuffer(samples[name], np.uint8)].tolist())
            roots.append(size)
            table[table > 0] += size - 1
            tables.append(table)
            size += len(table)
        self.delta = np.concatenate(tables).ravel()
        self.root = np.array(roots, np.int32)

    def _automaton(self, symbols: list[int]) -> np.ndarray:
        """Transitions of the minimal automaton of all substrings; states from 1, 1 the first."""
        moves: list[dict[int, int]] = [{}]
        length, link, last = [0], [-1], 0
        for c in symbols:
            new = len(moves)
            moves.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p != -1 and c not in moves[p]:
                moves[p][c] = new
                p = link[p]
            if p != -1:
                q = moves[p][c]
                if length[q] == length[p] + 1:
                    link[new] = q
                else:
                    clone = len(moves)
                    moves.append(dict(moves[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p != -1 and moves[p].get(c) == q:
                        moves[p][c] = clone
                        p = link[p]
                    link[q] = link[new] = clone
            last = new
        table = np.zeros((len(moves), self.width), np.int32)
        for state, to in enumerate(moves):
            for c, q in to.items():
                table[state, c] = q + 1
        return table

    def phrases(self, texts: list[bytes]) -> np.ndarray:
        """Longest-match phrases of each text against each language: texts x languages."""
        return self.parsed(texts)[0]

    def parsed(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Phrases as above, and of each text the phrases if every block takes its best language."""
        n = len(self.languages)
        out, fewest = np.zeros((len(texts), n), np.int64), np.zeros(len(texts), np.int64)
        sizes = np.array([len(t) for t in texts])
        data = self.symbol[np.frombuffer(b"".join(texts), np.uint8)]
        blocks = -(-sizes // BLOCK)
        owner = np.repeat(np.arange(len(texts)), blocks)
        order = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        start = np.repeat(np.cumsum(sizes) - sizes, blocks) + order * BLOCK
        length = np.minimum(BLOCK, sizes[owner] - order * BLOCK)
        by = np.argsort(-length, kind="stable")
        owner, start, length = owner[by], start[by], length[by]
        for a in range(0, len(owner), max(1, _LANES // n)):
            b = min(len(owner), a + max(1, _LANES // n))
            walked = self._walk(data, start[a:b], length[a:b])
            np.add.at(out, owner[a:b], walked)
            np.add.at(fewest, owner[a:b], walked.min(axis=1))
        return out, fewest

    def _walk(self, data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Phrases of blocks that are sorted by falling length: blocks x languages."""
        # Phrases are counted where they begin: on a dead step. All begin dead, as after an unknown byte.
        state = np.zeros((len(start), len(self.root)), np.int32)
        count = np.zeros_like(state)
        first = self.delta[self.root[:, None] * self.width + np.arange(self.width)[None, :]].T
        live = np.searchsorted(-length, -np.arange(1, int(length.max(initial=0)) + 1), side="right")
        for k, m in enumerate(live.tolist()):
            c = data[start[:m] + k]
            now = state[:m]
            now *= self.width
            now += c[:, None]
            step = self.delta.take(now)
            dead = step == 0
            count[:m] += dead
            state[:m] = np.where(dead, first[c], step)
        return count


def labelled_sample(docs: DataFrame, label: Column, part: Column, docs_per_language: int = DOCS, sample: int = SAMPLE) -> dict[str, bytes]:
    """A bounded sample of text per language. Only the picked documents' first characters are read to the driver."""
    key = F.xxhash64("doc_id", F.lit(11))
    rows = docs.where(part & label.isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", "text", label.alias("label"), key.alias("key"))
    place = F.pmod(F.xxhash64("doc_id", F.lit(12)), F.lit(DRAWS))
    drawn = rows.groupBy("label", place.alias("place")).agg(F.min("key").alias("key")).select("label", "key").limit(LABELS * DRAWS + 1).collect()
    keys: dict[str, list[int]] = {}
    for r in drawn:
        keys.setdefault(r.label, []).append(r.key)
    if len(keys) > LABELS or len(drawn) > LABELS * DRAWS:
        raise ValueError(f"more than {LABELS} labels: not a column of languages")
    if not keys:
        return {}
    sample = min(sample, SAMPLES // len(keys))
    picked = [(name, k) for name, found in keys.items() for k in sorted(found)[:docs_per_language]]
    wanted = docs.sparkSession.createDataFrame(picked, "label string, key long")
    # Rows that repeat an id give one text: the smallest of their beginnings.
    texts = rows.join(F.broadcast(wanted), ["label", "key"]).groupBy("label", "key").agg(F.min(F.substring("text", 1, 2 * SHARE)).alias("text"))
    parts: dict[str, list[bytes]] = {}
    for r in sorted(texts.collect(), key=lambda r: (r.label, r.key)):
        if r.text and (plain := normalised(r.text)[:SHARE]):
            parts.setdefault(r.label, []).append(plain)
    return {name: b" ".join(found)[:sample] for name, found in parts.items()}


def _judged(model: Automata, texts: list) -> tuple[list[str], list[float], np.ndarray]:
    """Of each text the language, the score, and whether learned languages fit it."""
    names, scores, fits = ["und"] * len(texts), [0.0] * len(texts), np.zeros(len(texts), bool)
    rows = [k for k, t in enumerate(texts) if t and _LETTER.search(t)] if model.languages else []
    if rows:
        plain = [normalised(texts[k]) for k in rows]
        sizes = np.array([len(t) for t in plain])
        found, fewest = model.parsed(plain)
        best = found.argmin(axis=1)
        least = found.min(axis=1)
        fits[rows] = fewest + sizes // -BLOCK <= FIT * sizes + SLACK
        found[np.arange(len(rows)), best] = np.iinfo(np.int64).max
        score = 1 - least / found.min(axis=1)
        for k, i, x in zip(rows, best.tolist(), score.tolist(), strict=True):
            names[k], scores[k] = model.languages[i], x
    return names, scores, fits


def identify(docs: DataFrame, samples: dict[str, bytes], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred and score of every text."""
    docs = documents_of(docs, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(Automata(samples))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for whole in batches:
            for a in range(0, whole.num_rows, 1024):
                batch = whole.slice(a, 1024)
                names, scores, _ = _judged(model, batch.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])

    return docs.mapInArrow(run, "doc_id long, lang_pred string, score double")


def in_known_language(docs: DataFrame, samples: dict[str, bytes], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, whose text gets a language and is fitted by learned ones, judged in the parse of `identify`."""
    shared = docs.sparkSession.sparkContext.broadcast(Automata(samples))

    def keep(batch: pa.RecordBatch) -> np.ndarray:
        texts = batch.column("text").to_pylist()
        return np.concatenate([np.zeros(0, bool), *(_judged(shared.value, texts[a : a + 1024])[2] for a in range(0, len(texts), 1024))])

    return filtered_rows(docs, keep, id_col, text_col)


def held_out(id_col: str = "doc_id") -> Column:
    """The fold that nothing is learnt from; a null id is in no fold."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Fit on the labelled documents outside the held-out fold and predict all: doc_id, held_out, lang_pred, score."""
    return identify(docs, fitted(docs, id_col, text_col, lang_col), id_col, text_col).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def fitted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict[str, bytes]:
    known = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    return labelled_sample(known, F.col("lang"), ~held_out())
