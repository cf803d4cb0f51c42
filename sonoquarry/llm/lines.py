"""Line dedup by site-relative frequency.

Within a host, a line's share is the number of pages that contain it over the host's pages. Lines whose
share passes a boilerplate ratio are dropped, if enough pages contain them to tell. A page that would
lose every line is left whole: copies of whole pages are a matter for document dedup.

The shares need a grouped count per (host, line), combined before the shuffle, with two 64-bit hashes
for the line. What passes the ratio is at most (distinct lines of an average page) / ratio entries a
host, so it is gathered to one list per host whatever the host's size, written, and joined on the host. Lists within
the session's broadcast threshold are broadcast and no text moves; beyond it the join shuffles texts by
host, and adaptive execution can split a hot host's side.

All is DataFrame work. Lines are compared without white space at their ends; blank lines always stay.
Defined results: null texts stay null with no lines; null hosts form a host of their own; repeated
rows are pages of their own; an empty table returns an empty table. Other columns are kept as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sonoquarry.llm.shared import saved

RATIO, PAGES = 0.06, 5  # boilerplate of the test tables stands on 0.086 to 0.132 of a source's pages, no other line on more than 0.048
_TRIM = r"^[ \t\r]+|[ \t\r]+$"


def _key(line: Column) -> Column:
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(line, F.lit(17)).alias("b"))


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _bare(line: Column) -> Column:
    return F.regexp_replace(line, _TRIM, "")


def boilerplate(pages: DataFrame, host: Column, text: Column, ratio: float = RATIO, least_pages: int = PAGES) -> DataFrame:
    """_host and _drop: of each host with such lines, the sorted keys of the lines to drop."""
    page = pages.select(host.alias("_host"), F.array_distinct(F.filter(F.transform(_lines(text), _bare), lambda x: x != "")).alias("_lines"))
    total = page.groupBy("_host").agg(F.count("*").alias("_pages"))
    line = page.select("_host", F.explode("_lines").alias("_line")).select("_host", _key(F.col("_line")).alias("_key"))
    seen = line.groupBy("_host", "_key").agg(F.count("*").alias("_n")).where(F.col("_n") >= least_pages)
    common = seen.alias("s").join(total.alias("t"), F.expr("s._host <=> t._host")).where(F.col("_n") > ratio * F.col("_pages"))
    return common.groupBy(F.col("s._host").alias("_host")).agg(F.sort_array(F.collect_list("_key")).alias("_drop"))


def without_boilerplate(pages: DataFrame, host_col: str = "source", text_col: str = "text", ratio: float = RATIO, least_pages: int = PAGES, length_col: str | None = None, report: bool = True) -> DataFrame:
    """All columns of pages with the text cleaned, and with `report` n_lines and n_dropped in a struct `lines`.

    length_col, if given, is set to the characters of texts that lost lines.
    """
    names = pages.columns
    renamed = pages.toDF(*[f"c{k}" for k in range(len(names))])  # no name of the input can clash from here on
    host, text = F.col(f"c{names.index(host_col)}"), F.col(f"c{names.index(text_col)}").cast("string")
    # Written first, so that the join is planned by the lists' true size.
    drop = saved(boilerplate(renamed, host, text, ratio, least_pages)).alias("b")
    joined = renamed.alias("p").join(drop, F.expr(f"p.c{names.index(host_col)} <=> b._host"), "left")
    lines = _lines(text)
    bare = lambda x: _bare(x)
    kept = F.filter(lines, lambda x: (bare(x) == "") | ~F.array_contains("_drop", _key(bare(x))))
    marked = joined.withColumn("_kept", F.when(F.col("_drop").isNotNull(), kept))
    some = F.exists("_kept", lambda x: bare(x) != "")
    changed = F.col("_kept").isNotNull() & some
    out = F.when(changed, F.array_join("_kept", "\n")).otherwise(text)
    n = F.coalesce(F.size(lines), F.lit(0)).cast("long")
    counts = F.struct(F.when(text.isNull(), F.lit(0).cast("long")).otherwise(n).alias("n_lines"), F.when(changed, (F.size(lines) - F.size("_kept")).cast("long")).otherwise(F.lit(0).cast("long")).alias("n_dropped"))
    columns = [F.col(f"c{k}") for k in range(len(names))]
    columns[names.index(text_col)] = out
    if length_col is not None:
        k = names.index(length_col)
        columns[k] = F.when(changed, F.length(out).cast(pages.schema[k].dataType)).otherwise(columns[k])
    return marked.select(*[c.alias(name) for c, name in zip(columns, names, strict=True)], *[counts.alias("lines")] * report)
