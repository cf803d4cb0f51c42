"""URL filters: longest-match rules, and a cascade of Bloom filters for exact membership in a list.

Keys are hosts with all their parent domains. The first filter of the cascade encodes the listed keys
that occur in the corpus; the second those other keys of the corpus that the first one lets through;
the third the listed keys that the second lets through; and so on until a filter lets nothing wrong
through. As every key of the corpus took part, membership of each is exact, without a join: a lookup
tests bits of arrays that stand in the plan. Filters are small (a few bits for each listed key that
occurs); a list whose filters would pass MAX_BITS is looked up by a semi-join instead.

All is DataFrame work. Defined results: a null url, or one without ://, has empty host and path, no
rule and is allowed; repeated rows each return a row; an empty table returns an empty table; ties
between rules of one length go to the one that is smaller as text. Other columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sonoquarry.llm.shared import saved

MAX_BITS = 1 << 22
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


# The rules of the registered query: fixed values.
RULES = [Rule("block", "com", "/en/"), Rule("allow", "example.com", "/en/7"), Rule("allow", "net", "/de/"), Rule("block", "example.net", "/de/8"), Rule("block", "org", "/es/")]
# Hosts on the list of the registered query, with all their subdomains: fixed values.
LISTED = ["casino-win.example.com", "cheap-pills.example.com", "free-bets.example.com", "spam.example.net"]


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.locate("://", url) > 0, F.substring(url, F.locate("://", url) + F.lit(3), F.length(url)))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def matched(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, null where none does."""
    text = verdict = None
    for r in sorted(rules, key=lambda r: (-len(r.text), r.text)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        text = F.when(fits, r.text) if text is None else text.when(fits, r.text)
        verdict = F.when(fits, r.verdict) if verdict is None else verdict.when(fits, r.verdict)
    none = F.lit(None).cast("string")
    return (none, none) if text is None else (text, verdict)


def keys_of(host: Column) -> Column:
    """The host and all its parent domains."""
    labels = F.split(host, r"\.")
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")))


@dataclass(frozen=True)
class Filter:
    bits: int
    hashes: int
    salt: int
    words: list[int]

    def hits(self, key: Column) -> Column:
        table = F.from_json(F.lit("[" + ",".join(map(str, self.words)) + "]"), "array<bigint>")
        out = None
        for at in places(key, self.bits, self.hashes, self.salt):
            bit = F.getbit(F.element_at(table, (F.floor(at / 64) + 1).cast("int")), (at % 64).cast("int")) == 1
            out = bit if out is None else out & bit
        return out


def places(key: Column, bits: int, hashes: int, salt: int) -> list[Column]:
    """Bit positions of a key in a filter."""
    return [F.pmod(F.xxhash64(key, F.lit(salt), F.lit(k)), F.lit(bits)) for k in range(hashes)]


def _filter(keys: DataFrame, n: int, per_key: int, salt: int) -> Filter:
    """A filter of n keys: bits are set by one grouped bit_or, one row for each 64 of them."""
    bits, hashes = 64 * max(1, math.ceil(n * per_key / 64)), max(1, round(per_key * 0.69))
    at = keys.select(F.explode(F.array(*places(F.col("key"), bits, hashes, salt))).alias("at"))
    rows = at.groupBy(F.floor(F.col("at") / 64).alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(at % 64 as int)))").alias("mask")).collect()
    words = [0] * (bits // 64)
    for word, mask in rows:
        words[word] = mask
    return Filter(bits, hashes, salt, words)


class Cascade:
    """Filters of alternating meaning; exact for every key of the universe they were built over."""

    def __init__(self, filters: list[Filter]) -> None:
        self.filters = filters

    def contains(self, key: Column) -> Column:
        out = None
        for f in reversed(self.filters):
            out = f.hits(key) if out is None else f.hits(key) & ~out
        return F.lit(False) if out is None else out


def cascade(universe: DataFrame, listed: DataFrame, max_bits: int = MAX_BITS, first_bits: int = 10, later_bits: int = 4) -> Cascade | None:
    """universe and listed: distinct keys in a column `key`. None if a filter would pass max_bits."""
    inside = universe.join(listed, "key", "left_semi")
    outside = universe.join(listed, "key", "left_anti")
    n, filters = inside.count(), []
    while n:
        per_key = later_bits if filters else first_bits
        if n * per_key > max_bits:
            return None
        f = _filter(inside, n, per_key, len(filters))
        filters.append(f)
        wrong = saved(outside.where(f.hits(F.col("key"))))
        inside, outside = wrong, inside
        n = wrong.count()
    return Cascade(filters)


def filtered(pages: DataFrame, rules: list[Rule] | None = None, listed: DataFrame | list[str] | None = None, id_col: str = "page_id", url_col: str = "url", max_bits: int = MAX_BITS) -> DataFrame:
    """page_id, host, path, rule and verdict of every page; `listed` is whether a key of its host is on the list."""
    rules = RULES if rules is None else rules
    spark = pages.sparkSession
    listed = LISTED if listed is None else listed
    if isinstance(listed, list):
        listed = spark.range(1).select(F.explode(F.array(*[F.lit(x) for x in listed]) if listed else F.array().cast("array<string>")).alias("key"))
    listed = listed.select(F.translate("key", _UPPER, _LOWER).alias("key")).where("key is not null").distinct()
    host, path = host_and_path(F.col("url"))
    parsed = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url")).select("page_id", host.alias("host"), path.alias("path"))
    hosts = saved(parsed.select("host").distinct())
    universe = saved(hosts.select(F.explode(keys_of(F.col("host"))).alias("key")).distinct())
    found = cascade(universe, listed, max_bits)
    if found is not None:
        on_list = F.exists(keys_of(F.col("host")), found.contains) if found.filters else F.lit(False)
        judged = parsed.withColumn("listed", on_list)
    else:
        hit = hosts.select("host", F.explode(keys_of(F.col("host"))).alias("key")).join(listed, "key", "left_semi").select("host", F.lit(True).alias("hit")).distinct()
        judged = parsed.join(hit, "host", "left").withColumn("listed", F.coalesce("hit", F.lit(False)))
    text, verdict = matched(F.col("host"), F.col("path"), rules)
    return judged.select("page_id", "host", "path", text.alias("rule"), F.coalesce(verdict, F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"), "listed")
