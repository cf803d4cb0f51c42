"""Helpers shared by the operators of this subpackage: durable tables and connected components."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sonoquarry.storage import saved


def documents_of(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator reads, under fixed names: other columns can't clash with its own."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def release() -> None:
    """Gives memory that a Python worker no longer uses back to the system: workers outlive their tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def filtered_rows(docs: DataFrame, keep: Callable[[pa.RecordBatch], np.ndarray], id_col: str, text_col: str) -> DataFrame:
    """The rows for which keep(batch of doc_id and text) is true, with all columns, in one scan and no shuffle.

    Columns travel under numbers, so no name of theirs can clash.
    """
    names = docs.columns
    at_id, at_text = names.index(id_col), names.index(text_col)
    numbered = docs.toDF(*[f"c{k}" for k in range(len(names))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, 2048):
                batch = whole.slice(a, 2048)
                seen = pa.RecordBatch.from_arrays([batch.column(at_id), batch.column(at_text)], names=["doc_id", "text"])
                yield batch.filter(pa.array(keep(seen)))
        release()

    return numbered.mapInArrow(run, numbered.schema).toDF(*names)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components by alternating large-star and small-star steps.

    edges: two long columns a, b (any direction, repeats and loops allowed). Returns node, component
    for every node that is not its component's smallest; all others are their own component. Every
    step is a grouped minimum, combined before the shuffle, and a join back, which adaptive execution
    can split at a hot node. Rounds grow with the logarithm of the component size.
    """

    def star(e: DataFrame, large: bool) -> DataFrame:
        # e has a > b. Large star: every larger neighbour of u moves to u's smallest neighbour.
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v"))
        if large:
            both = both.unionByName(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        linked = both.join(least, "u")
        if large:
            out = linked.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        else:
            out = linked.select(F.explode(F.array("u", "v")).alias("a"), F.col("m").alias("b"))
        return out.where("a <> b").distinct()

    def mark(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    e = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    e = saved(e)
    before = mark(e)
    for _ in range(max_rounds):
        if before[0] == 0:
            break
        e = saved(star(star(e, True), False))
        now = mark(e)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return e.select(F.col("a").alias("node"), F.col("b").alias("component"))
