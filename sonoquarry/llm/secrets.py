"""Secret scans with linking of multipart credentials.

Three kinds are reported wherever they stand: assignments to a telling name, access key ids, and long
hexadecimal strings. Weak candidates are only parts of a credential: an identifier (who), a secret
under a vague name (what) and an endpoint (where). They are joined as intervals within a scope, which
is a paragraph: each part reaches REACH characters to both sides, and is reported only if its reach
meets a complementary part: identifiers and endpoints need a secret, weak secrets need an identifier or
an endpoint. Reported secrets of the three kinds count as secrets here.

The join runs inside a text, so nothing is shuffled; sorted intervals are met by bisection. Texts are
first tried with a linear-time pattern over the whole Arrow column, and only those that pass are
searched for positions. Positions count code points of the whole text, end exclusive.

Defined results: null and empty texts have no spans; repeated rows each return a row; an empty table
returns an empty table. Other columns are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sonoquarry.llm.shared import documents_of

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "identifier", "weak_secret", "endpoint")
REACH = 200
_SECRET, _WHO, _WHERE = {"assign", "hex", "weak_secret"}, {"access", "identifier"}, {"endpoint"}

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # as AKIA[A-Z0-9]+ of 20 or more: the run is taken whole either way
_HEX = re.compile(r"[0-9a-f]{24,}")
_IDENTIFIER = re.compile(r"""\b(?:user(?:name|_?id)?|login|account|client_?id|access_?key_?id|principal)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._-]{3,})""", re.I | re.A)
_WEAK = re.compile(r"""\b(?:pass|pwd|pin|auth|cred(?:ential)?s?|private_?key|access_?key|key)["']?\x20*[:=]\x20*["']?([^\s"',;]{4,})""", re.I | re.A)
_ENDPOINT = re.compile(r"""\b(?:https?|ftp|ssh|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqps?)://[^\s"'<>]+|\b(?:host|server|endpoint)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._-]{3,}(?::\d+)?|\b\d{1,3}(?:\.\d{1,3}){3}(?::\d+)?\b""", re.I | re.A)
_PARAGRAPH = re.compile(r"\n[ \t\r]*\n")
# Linear-time patterns that every text with a base span, or with a weak secret, matches.
_GATES = {
    "assign": r"""(?i)(password|passwd|secret|token|api_?key)["']? *[:=] *["']?[A-Za-z0-9+/_.=-]{6}""",
    "access": r"AKIA[A-Z0-9]{16}",
    "hex": r"[0-9a-f]{24}",
    "weak_secret": r"""(?i)(pass|pwd|pin|auth|creds?|credentials?|key)["']? *[:=]""",
}


def base_spans(text: str, kinds: set[str] | None = None) -> list[tuple[int, int, str]]:
    out = []
    if kinds is None or "assign" in kinds:
        out += [(*m.span(), "assign") for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if kinds is None or "access" in kinds:
        out += [(*m.span(), "access") for m in _ACCESS.finditer(text)]
    if kinds is None or "hex" in kinds:
        out += [(*m.span(), "hex") for m in _HEX.finditer(text)]
    return out


def _meets(parts: list[tuple[int, int, str]], kinds: set[str], scope: tuple[int, int], reach: int):
    """A test whether a span comes within reach of a part of these kinds in the scope."""
    mine = sorted((a, b) for a, b, k in parts if k in kinds and scope[0] <= a < scope[1])
    starts, latest = [a for a, _ in mine], []
    for _, b in mine:
        latest.append(max(b, latest[-1]) if latest else b)

    def test(a: int, b: int) -> bool:
        n = bisect_left(starts, b + reach + 1)  # parts that begin in time; does any of them end late enough?
        return n > 0 and latest[n - 1] >= a - reach

    return test


def linked_spans(text: str, base: list[tuple[int, int, str]], reach: int = REACH) -> list[tuple[int, int, str]]:
    """Weak candidates whose complementary parts stand near them in the same paragraph."""
    taken = sorted((a, b) for a, b, _ in base)
    starts = [a for a, _ in taken]
    ends = []
    for _, b in taken:
        ends.append(max(b, ends[-1]) if ends else b)

    def free(a: int, b: int) -> bool:
        n = bisect_left(starts, b)
        return n == 0 or ends[n - 1] <= a

    weak = [(*m.span(), kind) for kind, p in (("identifier", _IDENTIFIER), ("weak_secret", _WEAK), ("endpoint", _ENDPOINT)) for m in p.finditer(text)]
    weak = [x for x in weak if free(x[0], x[1])]
    if not weak:
        return []
    edges = [0, *(m.end() for m in _PARAGRAPH.finditer(text)), len(text) + 1]
    by_scope: dict[int, list] = {}
    for x in [*base, *weak]:
        by_scope.setdefault(bisect_left(edges, x[0] + 1) - 1, []).append(x)
    out = []
    for s, parts in by_scope.items():
        scope = (edges[s], edges[s + 1])
        secret, who_or_where = _meets(parts, _SECRET, scope, reach), _meets(parts, _WHO | _WHERE, scope, reach)
        out += [x for x in parts if x[2] not in BASE and (who_or_where if x[2] == "weak_secret" else secret)(x[0], x[1])]
    return out


def _order(span: tuple[int, int, str]) -> tuple[int, int, int]:
    return span[0], KINDS.index(span[2]), span[1]


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int = REACH) -> DataFrame:
    """doc_id and spans array<struct<kind, start, end>> of every text, by start and then kind."""
    docs = documents_of(docs, id_col, text_col)
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, 1024):
                batch = whole.slice(a, 1024)
                column = batch.column("text").fill_null("")
                hit = {k: set(pc.indices_nonzero(pc.match_substring_regex(column, p)).to_pylist()) for k, p in _GATES.items()}
                found: list[list] = [[]] * len(column)
                for row in set().union(*hit.values()):
                    text = column[row].as_py()
                    base = base_spans(text, {k for k in BASE if row in hit[k]})
                    if base or row in hit["weak_secret"]:
                        spans = sorted(base + linked_spans(text, base, reach), key=_order)
                        found[row] = [{"kind": k, "start": s, "end": e} for s, e, k in spans]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.list_(span))], names=["doc_id", "spans"])

    return docs.mapInArrow(run, "doc_id long, spans array<struct<kind: string, start: long, `end`: long>>")


def report(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, their digest, and all spans as text."""
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    shown = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    return found.select("doc_id", *(count(k) for k in BASE), F.sha2(shown(base).cast("binary"), 256).alias("base_sha256"), shown(F.col("spans")).alias("spans"))
