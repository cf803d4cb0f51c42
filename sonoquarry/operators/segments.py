"""Cutting recordings into clips: silence runs, pieces, greedy merges, hard-cap splits, trimmed pauses.

Runs and pieces are window functions. Greedy merges depend on all earlier choices of their recording:
they are folds over its sorted array, inside the JVM. The hard-cap split picks data-dependent places
repeatedly and runs on one utterance's words at a time.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from sonoquarry.config import DEFAULT, Config


def silence_runs(frames: DataFrame, cfg: Config = DEFAULT, key: str = "source_id", time: str = "t", level: str = "dbfs") -> DataFrame:
    """Runs of frames below the threshold: key, run_start, run_end, cut (the middle).

    A run ends at the first frame that is not silent, or at the last frame of the recording.
    """
    w = Window.partitionBy(key).orderBy(time)
    quiet = F.col(level) < cfg.silence_dbfs
    marked = frames.select(key, F.col(time).alias("_t"), F.coalesce(quiet, F.lit(False)).alias("_q"), F.lead(time).over(w).alias("_next"))
    w = Window.partitionBy(key).orderBy("_t")
    change = F.when(F.col("_q") != F.lag("_q", 1, False).over(w), 1).otherwise(0)
    runs = marked.withColumn("_c", change).withColumn("_run", F.sum("_c").over(w))
    found = runs.where("_q").groupBy(key, "_run").agg(F.min("_t").alias("run_start"), F.max(F.coalesce("_next", "_t")).alias("run_end"))
    return found.where(F.col("run_end") - F.col("run_start") >= cfg.min_silence_sec).select(key, "run_start", "run_end", ((F.col("run_start") + F.col("run_end")) / 2).alias("cut"))


def pieces(cuts: DataFrame, totals: DataFrame, key: str = "source_id", least: float = 0.05) -> DataFrame:
    """Stretches between cuts, from 0 to the recording's duration_sec; slivers are dropped."""
    edges = cuts.select(key, F.col("cut").alias("start")).unionByName(totals.select(key, F.lit(0.0).alias("start"))).unionByName(totals.select(key, F.col("duration_sec").alias("start")))
    end = F.lead("start").over(Window.partitionBy(key).orderBy("start"))
    return edges.withColumn("end", end).where(F.col("end") - F.col("start") > least)


def merged_spans(spans: Column, longest: float) -> Column:
    """Greedy merge of a sorted array of (start, end): extend while the whole stays within `longest`."""
    start = F.array().cast("array<struct<start: double, end: double>>")

    def step(done: Column, s: Column) -> Column:
        last = F.element_at(done, -1)
        fits = (F.size(done) > 0) & (s["end"] - F.when(F.size(done) > 0, last["start"]) <= longest)
        grown = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(last["start"].alias("start"), s["end"].alias("end"))))
        return F.when(fits, grown).otherwise(F.concat(done, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end")))))

    return F.aggregate(spans, start, lambda done, s: F.when(F.size(done) == 0, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end")))).otherwise(step(done, s)))


def merged_pieces(parts: DataFrame, cfg: Config = DEFAULT, key: str = "source_id") -> DataFrame:
    """One row per merged clip: key, start, end. A recording's pieces are bounded by its length."""
    one = parts.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col("start").cast("double").alias("start"), F.col("end").cast("double").alias("end")))).alias("_s"))
    return one.select(key, F.explode(merged_spans(F.col("_s"), cfg.preferred_max_sec)).alias("_m")).select(key, "_m.start", "_m.end")


def padded(clips: DataFrame, totals: DataFrame, cfg: Config = DEFAULT, key: str = "source_id") -> DataFrame:
    """Pads within the recording, drops clips that stay too short, notes those that stay too long."""
    out = clips.join(totals.select(key, F.col("duration_sec").alias("_total")), key)
    start, end = F.greatest(F.lit(0.0), F.col("start") - cfg.start_pad_sec), F.least(F.col("_total"), F.col("end") + cfg.end_pad_sec)
    out = out.select(key, start.alias("start_sec"), end.alias("end_sec"), (end - start).alias("duration_sec"))
    return out.where(F.col("duration_sec") >= cfg.min_clip_sec).withColumn("no_pause_to_split", F.col("duration_sec") > cfg.hard_cap_sec + cfg.duration_slack_sec)


def merged_segments(segments: DataFrame, cfg: Config = DEFAULT, key: str = "source_id", order: str = "id") -> DataFrame:
    """Adds group_no: a segment joins the group before it if the gap and the whole length allow.

    Segments without words are left out first, if there is a words column.
    """
    if "words" in segments.columns:
        segments = segments.where(F.size("words") > 0)
    rows = segments.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col("start").cast("double").alias("s"), F.col("end").cast("double").alias("e")))).alias("_a"))
    zero = F.struct(F.array().cast("array<struct<o: bigint, g: bigint>>").alias("out"), F.lit(0).cast("bigint").alias("g"), F.lit(None).cast("double").alias("first"), F.lit(None).cast("double").alias("last"))

    def step(acc: Column, x: Column) -> Column:
        joins = F.coalesce((x["s"] - acc["last"] <= cfg.max_merge_gap_sec) & (x["e"] - acc["first"] <= cfg.preferred_max_sec), F.lit(False))
        g = F.when(joins, acc["g"]).otherwise(acc["g"] + 1)
        entry = F.struct(x["o"].cast("bigint").alias("o"), g.alias("g"))
        return F.struct(F.concat(acc["out"], F.array(entry)).alias("out"), g.alias("g"), F.when(joins, acc["first"]).otherwise(x["s"]).alias("first"), x["e"].alias("last"))

    found = rows.select(key, F.explode(F.aggregate("_a", zero, step, lambda acc: acc["out"])).alias("_x")).select(key, F.col("_x.o").alias(order), F.col("_x.g").alias("group_no"))
    return segments.join(found, [key, order])


def group_stats(segments: DataFrame, key: str = "source_id") -> DataFrame:
    """Per merged group: duration-weighted log probability and the worst decoder signals."""
    weight = F.greatest(F.lit(0.001), F.col("end") - F.col("start"))
    return segments.groupBy(key, "group_no").agg(
        F.count("*").alias("n_segments"), F.min("start").alias("start_sec"), F.max("end").alias("end_sec"),
        (F.sum(F.col("avg_logprob") * weight) / F.sum(weight)).alias("avg_logprob"),
        F.max("no_speech_prob").alias("no_speech_prob"), F.max("compression_ratio").alias("compression_ratio"),
    )


def split_words(starts: list[float], ends: list[float], cap: float, least: float) -> list[tuple[int, int]]:
    """Index ranges of words after splitting at the largest legal gaps; a stretch without one stays whole."""
    done, todo = [], [(0, len(starts))]
    while todo:
        a, b = todo.pop()
        if b <= a:
            continue
        best = None
        if ends[b - 1] - starts[a] > cap:
            legal = [(starts[k + 1] - ends[k], -k) for k in range(a, b - 1) if least <= ends[k] - starts[a] <= cap and ends[b - 1] - starts[k + 1] >= least]
            legal = [x for x in legal if x[0] > -1]
            best = max(legal, default=None)
        if best is None:
            done.append((a, b))
        else:
            k = -best[1]
            todo += [(k + 1, b), (a, k + 1)]
    return done


def hard_cap_split(words: DataFrame, cfg: Config = DEFAULT, key: str = "group_id", order: str = "pos") -> DataFrame:
    """Adds chunk_no and unsplittable to words (key, order, start, end); one utterance is one row of arrays."""

    @pandas_udf("array<array<bigint>>")
    def chunks(starts: pd.Series, ends: pd.Series) -> pd.Series:
        return pd.Series([[list(x) for x in split_words(list(s), list(e), cfg.hard_cap_sec, cfg.min_clip_sec)] for s, e in zip(starts, ends, strict=True)])

    one = words.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col("start").cast("double").alias("s"), F.col("end").cast("double").alias("e")))).alias("_w"))
    cut = one.withColumn("_c", chunks(F.transform("_w", lambda w: w["s"]), F.transform("_w", lambda w: w["e"])))
    rows = cut.select(key, "_w", F.posexplode("_c").alias("chunk_no", "_r"))
    part = rows.withColumn("_p", F.slice("_w", (F.col("_r")[0] + 1).cast("int"), (F.col("_r")[1] - F.col("_r")[0]).cast("int")))
    whole = F.element_at("_p", -1)["e"] - F.element_at("_p", 1)["s"]
    return part.select(key, "chunk_no", (whole > cfg.hard_cap_sec).alias("unsplittable"), F.explode("_p").alias("_x")).select(key, F.col("_x.o").alias(order), F.col("_x.s").alias("start"), F.col("_x.e").alias("end"), "chunk_no", "unsplittable")


def trimmed_pauses(words: DataFrame, cfg: Config = DEFAULT, key: str = "group_id", order: str = "pos") -> DataFrame:
    """Stretches of audio to keep: a long pause is cut to a short one, half at either side."""
    half = cfg.pause_target_sec / 2
    w = Window.partitionBy(key).orderBy(order)
    following = F.lead("start").over(w)
    long_pause = (following - F.col("end") > cfg.max_internal_pause_sec) & (following - half > F.col("end") + half)
    marked = words.withColumn("_cut", F.coalesce(long_pause, F.lit(False)))
    marked = marked.withColumn("_before", F.lag(F.col("_cut").cast("int"), 1, 0).over(w)).withColumn("span_no", F.sum("_before").over(w))
    spans = marked.groupBy(key, "span_no").agg(F.min_by("start", order).alias("_s"), F.max_by("end", order).alias("_e"), F.max("_cut").alias("_more"))
    first = F.col("span_no") == 0
    start = F.when(first, F.greatest(F.lit(0.0), F.col("_s") - cfg.word_pad_sec)).otherwise(F.col("_s") - half)
    end = F.when(F.col("_more"), F.col("_e") + half).otherwise(F.col("_e") + cfg.word_pad_sec)
    return spans.select(key, "span_no", start.alias("start"), end.alias("end"))
