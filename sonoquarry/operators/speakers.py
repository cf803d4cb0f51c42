"""Speaker rules: talk time, dominance, matches against registered voices, the registry over files."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sonoquarry.config import DEFAULT, Config
from sonoquarry.functions.text import fixed
from sonoquarry.operators.graph import LEFT, taken
from sonoquarry.storage import saved

TILE = 1024  # voiceprints a side of one matrix product
FIRST = 1 << 13  # voices of the first batch of a registry
PARTS, LARGEST = 16, 1 << 17  # blocks of voiceprints, and how many one may hold before there are more of them


def dominant(turns: DataFrame, key: str = "source_id", speaker: str = "speaker") -> DataFrame:
    """key, num_speakers, dominant_speaker (first seen on ties), dominant_fraction. turns have start and end."""
    talk = turns.groupBy(key, speaker).agg(F.sum(F.col("end") - F.col("start")).alias("talk"), F.min("start").alias("seen"))
    out = talk.groupBy(key).agg(F.count("*").alias("num_speakers"), F.max_by(speaker, F.struct("talk", -F.col("seen"))).alias("dominant_speaker"), F.max("talk").alias("_top"), F.sum("talk").alias("_all"))
    total = F.when(F.col("_all") == 0, 1.0).otherwise(F.col("_all"))
    return out.select(key, "num_speakers", "dominant_speaker", (F.col("_top") / total).alias("dominant_fraction"))


def minority_segments(turns: DataFrame, who: DataFrame, key: str = "source_id", speaker: str = "speaker") -> DataFrame:
    """key and minority_segments: sorted stretches of all but the dominant speaker."""
    others = turns.join(who.select(key, "dominant_speaker"), key).where(F.col(speaker) != F.col("dominant_speaker"))
    return others.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("minority_segments"))


def file_reason(cfg: Config = DEFAULT) -> Column:
    """Why a whole file goes: its speaker analysis failed, or no speaker dominates. Null if it stays."""
    failed = F.concat(F.lit("file_level:speaker_analysis_failed:"), F.coalesce("speaker_error", F.lit("")))
    many = F.concat(F.lit("file_level:multiple_speakers_no_dominant:"), F.col("num_speakers").cast("string"), F.lit("_top_"), fixed(F.col("dominant_fraction"), 2))
    return F.when(~F.coalesce("speaker_ran", F.lit(False)), failed).when((F.col("num_speakers") > 1) & (F.col("dominant_fraction") < cfg.dominant_fraction), many)


def _met(voices: DataFrame, known: DataFrame | None, pick: Callable[[np.ndarray], np.ndarray], block: int | None, ordered: bool = False, one: bool = False) -> DataFrame:
    """later, earlier and similarity where `pick` (similarities, -inf where a pair doesn't count) marks them.

    Voices are dealt to blocks and blocks meet in pairs, tile by tile: only marked pairs leave the task. An
    exact all-pairs search is quadratic by nature; its cells are spread evenly. A voice is sent once for each
    block, so blocks are few and grow with the voices: up to PARTS * LARGEST voices it is sent PARTS + 1 times.
    Without `known`, the voices meet each other, the later the earlier, two blocks in one task for both
    directions; with it they meet all known ones, or if `ordered` those of lower numbers. `one` leaves one row a
    voice and task, its best.
    """
    own = known is None
    deal = lambda df, n, seed: df.where("embedding is not null").select("seq", F.col("embedding").alias("e"), F.pmod(F.xxhash64("seq", F.lit(seed)), F.lit(n)).cast("int").alias("at"))

    def blocks(df: DataFrame) -> int:
        n = df.where("embedding is not null").count()
        return max(1, -(-n // (block or max(TILE, min(LARGEST, -(-n // PARTS))))))

    n = blocks(voices)
    m = n if own else blocks(known)
    first = F.col("at") if own else F.lit(0)  # of two own blocks the lower is on the left
    left = deal(voices, n, 1).select("seq", "e", F.col("at").alias("i"), F.explode(F.sequence(first, F.lit(m - 1))).alias("j"))
    right = deal(voices if own else known, m, 1).select("seq", "e", F.col("at").alias("j"), F.explode(F.sequence(F.lit(0), F.col("at") if own else F.lit(n - 1))).alias("i"))

    def tiles(z: pd.DataFrame) -> list[tuple[np.ndarray, np.ndarray]]:
        z = z.sort_values("seq")
        return [(z["seq"].to_numpy()[k : k + TILE], np.stack(z["e"].to_numpy()[k : k + TILE]).astype(np.float64)) for k in range(0, len(z), TILE)]

    def marked(sim: np.ndarray, later: np.ndarray, earlier: np.ndarray) -> pd.DataFrame:
        i, j = np.nonzero(pick(sim))
        return pd.DataFrame({"later": later[i], "earlier": earlier[j], "similarity": sim[i, j]})

    def run(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"later": np.zeros(0, np.int64), "earlier": np.zeros(0, np.int64), "similarity": np.zeros(0)})]
        if x.empty or y.empty:
            return out[0]
        same = own and x["i"].iloc[0] == y["j"].iloc[0]
        theirs = tiles(y)
        for seq, e in tiles(x):
            for other, f in theirs:
                sim = e @ f.T
                if not (own or ordered):
                    out.append(marked(sim, seq, other))
                    continue
                before = other[None, :] < seq[:, None]
                if before.any():
                    out.append(marked(np.where(before, sim, -np.inf), seq, other))
                if own and not same and not before.all():
                    out.append(marked(np.where(before, -np.inf, sim).T, other, seq))
        met = pd.concat([o for o in out if len(o)] or out, ignore_index=True)
        if one:
            met = met.assign(r=-met["similarity"].round(9)).sort_values(["later", "r", "earlier"]).drop_duplicates("later").drop(columns="r")
        return met

    right = right.toDF(*right.columns)  # columns of its own, though both sides may come from one table
    tasks = min(n * (n + 1) // 2 if own else n * m, 4096)  # else few bytes, of much work, would be put together
    left, right = left.repartition(tasks, "i", "j"), right.repartition(tasks, "i", "j")
    return left.groupBy("i", "j").cogroup(right.groupBy("i", "j")).applyInPandas(run, "later long, earlier long, similarity double")


def similarities(voices: DataFrame, least: float, known: DataFrame | None = None, block: int | None = None) -> DataFrame:
    """later, earlier and similarity of all pairs of voiceprints (seq, embedding) at or above a threshold."""
    return _met(voices, known, lambda sim: sim >= least, block)


def _best(voices: DataFrame, known: DataFrame | None, least: float, block: int | None = None, ordered: bool = False) -> DataFrame:
    """seq, matched_seq and similarity: each voice's most similar other one at or above a threshold, the first on ties.

    Similarities that agree to nine decimals are ties, as a product's last bits depend on the tile it is in.
    """

    def best(sim: np.ndarray) -> np.ndarray:
        top = sim.max(axis=1)
        out = np.zeros(sim.shape, bool)
        out[np.arange(len(sim)), (sim >= (np.round(top, 9) - 5e-10)[:, None]).argmax(axis=1)] = True
        return out & (sim > -np.inf) & (top >= least)[:, None]

    found = _met(voices, known, best, block, ordered, one=True).groupBy("later").agg(F.max(F.struct(F.round("similarity", 9).alias("r"), (-F.col("earlier")).alias("e"), "similarity")).alias("m"))
    return found.select(F.col("later").alias("seq"), (-F.col("m.e")).alias("matched_seq"), F.col("m.similarity").alias("similarity"))


def top_match(voices: DataFrame, block: int | None = None) -> DataFrame:
    """For each voice the most similar earlier one (the first registered on ties): seq, matched_seq, similarity."""
    return _best(voices, None, -np.inf, block)


def registered(voices: DataFrame, cfg: Config = DEFAULT, known: DataFrame | None = None, left: int = LEFT, first: int = FIRST) -> DataFrame:
    """Adds decision (new, review, duplicate), matched_seq and similarity to voices (seq, embedding, ...) in seq order.

    known, if given, are voices (seq, embedding) registered before all of these, whatever their numbers;
    matched_known says that the match is one of them. A voice too like a registered one is a duplicate and is
    not registered itself; the others are. A voice without an embedding is new and matches nothing.

    Voices come in batches by seq, each as large as all before it: they meet those registered so far, and only
    those that are left meet each other. So the pairs written are those of a batch's new voices, not all.
    """
    rest = voices.where("embedding is not null").select("seq", "embedding")
    matches: DataFrame | None = None
    if known is not None:
        matches = saved(_best(voices, known, cfg.speaker_review))
        rest = rest.join(matches.where(F.col("similarity") >= cfg.speaker_reject).select("seq"), "seq", "left_anti")
    rest = saved(rest)
    shares, n = [], rest.count()
    while n > first:
        n = -(-n // 2)
        shares.insert(0, 0.5 ** (len(shares) + 1))
    # Where batches end need not be exact.
    ends = rest.agg(F.percentile_approx("seq", shares, 10_000)).first()[0] if shares else []
    so_far: list[DataFrame] = []
    for low, high in zip([None, *ends], [*ends, None], strict=True):
        part = rest if low is None else rest.where(F.col("seq") > low)
        part = part if high is None else part.where(F.col("seq") <= high)
        if so_far:
            old = reduce(DataFrame.unionByName, so_far)
            part = saved(part.join(_best(part, old, cfg.speaker_reject).select("seq"), "seq", "left_anti"))
        gone = taken(similarities(part, cfg.speaker_reject).select(F.col("earlier").alias("a"), F.col("later").alias("b")), left)
        so_far.append(saved(part.join(gone.withColumnRenamed("node", "seq"), "seq", "left_anti")))
    best = _best(voices, reduce(DataFrame.unionByName, so_far), cfg.speaker_review, ordered=True).withColumn("old", F.lit(False))
    if matches is not None:
        best = best.unionByName(matches.withColumn("old", F.lit(True)))
    best = best.groupBy("seq").agg(F.max(F.struct(F.round("similarity", 9).alias("r"), "old", (-F.col("matched_seq")).alias("e"), "similarity")).alias("m"))
    found = best.select("seq", (-F.col("m.e")).alias("matched_seq"), F.col("m.similarity").alias("similarity"), F.col("m.old").alias("matched_known"))
    decision = F.when(F.col("similarity") >= cfg.speaker_reject, "duplicate").when(F.col("similarity").isNotNull(), "review").otherwise("new")
    joined = voices.join(found, "seq", "left").withColumn("decision", decision)
    return joined if known is not None else joined.drop("matched_known")


def registry_notes(decided: DataFrame, name: str = "source_id") -> DataFrame:
    """Adds file_reason for duplicates and speaker_note for borderline matches."""
    names = decided.select(F.col("seq").alias("matched_seq"), F.col(name).alias("_matched"))
    text = F.concat(F.col("_matched"), F.lit("_sim_"), fixed(F.col("similarity"), 2))
    out = decided.join(names, "matched_seq", "left").withColumn("_text", text)
    return out.withColumns(
        {
            "file_reason": F.when(F.col("decision") == "duplicate", F.concat(F.lit("file_level:speaker_already_in_dataset:matches_"), "_text")),
            "speaker_note": F.when(F.col("decision") == "review", F.concat(F.lit("speaker_borderline_match:"), "_text")),
        }
    ).drop("_text", "_matched")


def first_files(files: DataFrame, limit: int, key: str = "folder", order: str = "path") -> DataFrame:
    return files.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(order))).where(F.col("_n") <= limit).drop("_n")
