"""Byte-pair encoding and decoding by a depth-first walk over the trie of distinct words.

The last token of a word's encoding fixes the rest: what stands before it is the encoding of the
remaining prefix. So one state per prefix (its last token) describes all encodings, and words with a
common prefix share the states of that prefix. The distinct words of a slice of texts, sorted, are the
depth-first order of their trie: a stack holds the states on the path from the root, is cut back to
what the next word shares with it and extended by the rest. A token may follow another only if the
merges would never cross the place where they meet; this depends on the two tokens alone.

Which tokens can end at a prefix is read off an automaton of all tokens that walks along with the
stack: one step a symbol gives the tokens that end there, longest first. The end of a word is a symbol
of its own there, and the tokens that carry the vocabulary's word end are filed with it.

Words seen before are looked up in a table of bounded size. When it is full a new one takes its place
and the full one is kept behind it until the next change, so that words that recur are carried over:
the size changes the time, never a result.

Texts of Latin letters and punctuation are split here; for other scripts the normaliser and splitter
come from the vocabulary file through the tokenizers library. Special tokens standing in a text become
their ids, as in that library. Encoding is exact: tests hold it against the library. Decoding starts
from the ids alone.

Defined results: null and empty texts have no tokens and decode to the empty text; repeated rows each
return a row; very long words are encoded whole; a null doc_id is returned as it is. Other columns are
not read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame

from sonoquarry.llm.shared import documents_of, release

_TABLE_WORDS = 100_000
_TABLE_PAIRS = 500_000
_SLICE_CHARS = 1 << 20
_END = "\n"  # no printable symbol: stands for the end of a word
# Latin letters, digits and other numbers up to U+024F, and white space there: fixed by Unicode.
_LETTER, _NUMBER, _SPACE = "a-zªµºß-öø-ɏ", "0-9²³¹¼½¾", "\t-\r\x20\x85\xa0"
_ODD = re.compile("[^\x00-ɏ‐-‧‰-⁞]")
_SPLIT = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^{_SPACE}{_LETTER}{_NUMBER}]+")
_NEVER = 1 << 60


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    extra = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(extra)) for b in range(256)]


class Vocabulary:
    """A byte-level BPE vocabulary whose words end in a suffix symbol, read from a tokenizer file."""

    def __init__(self, path: str) -> None:
        self.source = Path(path).read_text()
        spec = json.loads(self.source)
        model = spec["model"]
        self.end = model["end_of_word_suffix"]
        self.ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.pieces = {i: s for s, i in [*self.ids.items(), *self.special.items()]}
        self.ranks = {(a, b): r for r, (a, b) in reversed(list(enumerate(model["merges"])))}
        # Of each token that its own text encodes to: the parts of its last merge and that merge's rank.
        self.parts: dict[str, tuple[str, str, int] | None] = {}
        for token in self.ids:
            parts = self._merged(token)
            if parts is not None or len(self._symbols(token)) == 1:
                self.parts[token] = parts

    def _symbols(self, token: str) -> list[str]:
        if token.endswith(self.end) and len(token) > len(self.end):
            return [*token[: -len(self.end) - 1], token[-len(self.end) - 1 :]]
        return list(token)

    def _merged(self, token: str) -> tuple[str, str, int] | None:
        """The last merge when the token's text is encoded; None if it doesn't become this token."""
        word, last = self._symbols(token), None
        while len(word) > 1:
            rank, at = min((self.ranks.get(pair, _NEVER), k) for k, pair in enumerate(zip(word, word[1:], strict=False)))
            if rank == _NEVER:
                return None
            last = (word[at], word[at + 1], rank)
            word[at : at + 2] = [word[at] + word[at + 1]]
        return last


class Endings:
    """An automaton over the tokens: after each symbol, the tokens that end there, longest first.

    moves[state] has the token trie's edges; a missing one is found over the state of the next shorter
    suffix and kept, so each is looked for once.
    """

    def __init__(self, spelt: dict[str, str]) -> None:
        """spelt: token -> its symbols, the end of a word being _END."""
        self.moves: list[dict[str, int]] = [{}]
        own: list[tuple[str, int] | None] = [None]
        for token, symbols in spelt.items():
            at = 0
            for c in symbols:
                to = self.moves[at].get(c)
                if to is None:
                    to = self.moves[at][c] = len(self.moves)
                    self.moves.append({})
                    own.append(None)
                at = to
            own[at] = (token, len(symbols.removesuffix(_END)))
        self.shorter = [0] * len(self.moves)
        self.tokens: list[tuple[tuple[str, int], ...]] = [()] * len(self.moves)
        level = [(0, c, to) for c, to in self.moves[0].items()]
        while level:  # by length, so shorter suffixes are complete
            below = []
            for parent, c, state in level:
                back = self._over(parent, c) if parent else 0
                self.shorter[state] = back
                self.tokens[state] = (own[state], *self.tokens[back]) if own[state] else self.tokens[back]
                below += [(state, d, to) for d, to in self.moves[state].items()]
            level = below

    def _over(self, state: int, c: str) -> int:
        while state:
            state = self.shorter[state]
            to = self.moves[state].get(c)
            if to is not None:
                return to
        return 0

    def step(self, state: int, c: str) -> int:
        to = self.moves[state].get(c)
        if to is None:
            to = self.moves[state][c] = self._over(state, c)
        return to


class Encoder:
    """Encodes texts with a vocabulary."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.v = vocabulary
        self.ids_of: dict[str, str] = {}  # word -> its ids, each after one space
        self.older: dict[str, str] = {}
        self.id_text = {s: f" {i}" for s, i in vocabulary.ids.items()}
        self.piece_of = {str(i): s for i, s in vocabulary.pieces.items()}
        self.meets: dict[tuple[str, str], bool] = {}
        self.right: dict[str, list[tuple[str, int]]] = {}
        self.left: dict[str, list[tuple[str, int]]] = {}
        self.symbols = byte_symbols()
        self.apart = re.compile("|".join(map(re.escape, sorted(vocabulary.special, key=len, reverse=True)))) if vocabulary.special else None
        self.library = None
        end = vocabulary.end
        self.endings = Endings({t: t[: -len(end)] + _END if t.endswith(end) and len(t) > len(end) else t for t in vocabulary.parts})

    def _edge(self, token: str, side: int) -> list[tuple[str, int]]:
        """Tokens that stood at this edge while the token was merged, and the rank that ended each."""
        out, rank = [], _NEVER
        while True:
            out.append((token, rank))
            parts = self.v.parts.get(token)
            if parts is None:
                return out
            token, rank = parts[side], parts[2]

    def _may_meet(self, a: str, b: str) -> bool:
        """Whether b can follow a in an encoding: no merge ever joins what stands on both sides."""
        if a not in self.right:
            self.right[a] = self._edge(a, 1)
        if b not in self.left:
            self.left[b] = self._edge(b, 0)
        ranks, left = self.v.ranks, self.left[b]
        known = True
        for x, x_end in self.right[a]:
            for y, y_end in left:
                r = ranks.get((x, y))
                # Of equal ranks the leftmost is merged first: a tie with a's own merge is lost, one with b's is won.
                if r is not None and r < x_end and r <= y_end:
                    known = False
        if len(self.meets) >= _TABLE_PAIRS:
            self.meets.clear()
        self.meets[a, b] = known
        return known

    def learn(self, words: set[str]) -> None:
        """Encode distinct words: one walk over their trie, in sorted order."""
        mapped = sorted([(w if w.isascii() and w.isprintable() else "".join([self.symbols[b] for b in w.encode()]), w) for w in words])
        tokens, moves, step = self.endings.tokens, self.endings.moves, self.endings.step
        id_text, meets, may_meet, ids_of = self.id_text, self.meets.get, self._may_meet, self.ids_of
        # Of the first k symbols on the path: the automaton's state, the last token of their encoding, its ids.
        state, last, ids, before = [0], [""], [""], ""
        for word, original in mapped:
            size = len(word)
            shared, most = 0, min(len(before), size)
            while shared < most and before[shared] == word[shared]:
                shared += 1
            del state[shared + 1 :], last[shared + 1 :], ids[shared + 1 :]
            at, end = state[shared], shared
            for c in word[shared:] + _END:
                to = moves[at].get(c)
                at = step(at, c) if to is None else to
                if c is not _END:
                    end += 1
                for token, length in tokens[at]:
                    if length == end:
                        break
                    known = meets((last[end - length], token))
                    if known or known is None and may_meet(last[end - length], token):
                        break
                else:
                    raise ValueError(f"{word!r} has a symbol outside the vocabulary")
                found = ids[end - length] + id_text[token]
                if c is not _END:
                    state.append(at)
                    last.append(token)
                    ids.append(found)
            ids_of[original] = found
            before = word

    def _words(self, text: str) -> list[str]:
        low = text.lower()
        if low.isascii() or not _ODD.search(low):
            return _SPLIT.findall(low)
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_str(self.v.source)
        codes = {s: b for b, s in enumerate(self.symbols)}
        plain = self.library.normalizer.normalize_str(text)
        return [bytes(codes[c] for c in w).decode("utf-8", "surrogateescape") for w, _ in self.library.pre_tokenizer.pre_tokenize_str(plain)]

    def encode(self, texts: list[str | None]) -> Iterator[tuple[int, str]]:
        """For each text: the number of tokens and their ids, joined by one space."""
        a = 0
        while a < len(texts):
            part, size, fresh = [], 0, set()
            while a < len(texts) and (not part or size < _SLICE_CHARS):
                text = texts[a] or ""
                a, size = a + 1, size + len(text)
                if self.apart is not None and self.apart.search(text):
                    pieces, at = [], 0
                    for m in self.apart.finditer(text):
                        pieces += [self._words(text[at : m.start()]), m[0]]
                        at = m.end()
                    part.append([*pieces, self._words(text[at:])])
                else:
                    part.append([self._words(text)])
                for words in part[-1]:
                    if isinstance(words, list):
                        fresh.update(words)
            missing = fresh.difference(self.ids_of)
            if missing:
                if len(self.ids_of) + len(missing) > _TABLE_WORDS:
                    self.older, self.ids_of = self.ids_of, {}
                    missing = fresh
                known = missing.intersection(self.older)
                self.ids_of.update(zip(known, map(self.older.__getitem__, known)))
                self.learn(missing.difference(known))
            ids_of, special = self.ids_of.__getitem__, self.v.special
            for pieces in part:
                ids = "".join(["".join(map(ids_of, x)) if isinstance(x, list) else f" {special[x]}" for x in pieces])
                yield ids.count(" "), ids[1:]

    def decode(self, ids: str) -> str:
        """Text of ids that stand in a string, parted by spaces."""
        return " ".join(map(self.piece_of.__getitem__, ids.split()))


@lru_cache(maxsize=2)
def _encoder(key: str, load: Callable[[], Vocabulary]) -> Encoder:
    return Encoder(load())


class _Loaded:
    """A broadcast vocabulary under a key, so that a worker builds its encoder once."""

    def __init__(self, shared, key: str) -> None:
        self.shared, self.key = shared, key

    def __hash__(self) -> int:
        return hash(self.key)

    def __eq__(self, other: object) -> bool:
        return isinstance(other, _Loaded) and other.key == self.key

    def __call__(self) -> Vocabulary:
        return self.shared.value


def _mapped(docs: DataFrame, vocabulary: str, id_col: str, text_col: str, schema: str, row: Callable) -> DataFrame:
    docs = documents_of(docs, id_col, text_col)
    v = Vocabulary(vocabulary)
    load = _Loaded(docs.sparkSession.sparkContext.broadcast(v), hashlib.sha256(v.source.encode()).hexdigest())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(load.key, load)
        try:
            for whole in batches:
                for a in range(0, whole.num_rows, 1024):
                    batch = whole.slice(a, 1024)
                    columns = row(encoder, batch.column("text").to_pylist())
                    yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns.values()], names=["doc_id", *columns])
        finally:  # the worker lives on and serves other operators
            release()

    return docs.mapInArrow(run, f"doc_id long, {schema}")


def _ids(encoder: Encoder, texts: list) -> dict[str, pa.Array]:
    found = [[int(i) for i in ids.split()] for _, ids in encoder.encode(texts)]
    return {"ids": pa.array(found, pa.list_(pa.int32()))}


def _digests(encoder: Encoder, texts: list) -> dict[str, pa.Array]:
    n, sums, texts_out = [], [], []
    for count, ids in encoder.encode(texts):
        n.append(count)
        sums.append(hashlib.sha256(ids.encode()).hexdigest())
        texts_out.append(hashlib.sha256(encoder.decode(ids).encode()).hexdigest())
    return {"n_tokens": pa.array(n, pa.int64()), "ids_sha256": pa.array(sums, pa.string()), "decoded_sha256": pa.array(texts_out, pa.string())}


def encode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids array<int> of every text."""
    return _mapped(docs, vocabulary, id_col, text_col, "ids array<int>", _ids)


def decode(encoded: DataFrame, vocabulary: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id and text of every row of ids; null ids give a null text."""
    shared = encoded.sparkSession.sparkContext.broadcast(Vocabulary(vocabulary).pieces)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = shared.value
        for batch in batches:
            texts = [None if ids is None else " ".join([pieces[i] for i in ids]) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.selectExpr(f"cast(`{id_col}` as long) doc_id", f"cast(`{ids_col}` as array<int>) ids").mapInArrow(run, "doc_id long, text string")


def digests(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, and digests of the ids and of the text that Encoder.decode gives for them."""
    return _mapped(docs, vocabulary, id_col, text_col, "n_tokens long, ids_sha256 string, decoded_sha256 string", _digests)
