"""Maintenance over manifests: resume, purge, promote, package, trim, number words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sonoquarry.config import DEFAULT, Config
from sonoquarry.functions.numbers import with_number_words


def stale(cfg: Config = DEFAULT) -> Column:
    """Whether a source's file is not the one a state was written for."""
    return (F.col("source_size") != F.col("size")) | (F.abs(F.col("source_mtime") - F.col("mtime")) > cfg.mtime_slack_sec)


def to_process(sources: DataFrame, states: DataFrame, force: bool = False, cfg: Config = DEFAULT) -> DataFrame:
    """Sources (source_id, size, mtime) without a completed state that still fits them."""
    if force:
        return sources
    done = states.where("status = 'completed'").select("source_id", "source_size", "source_mtime")
    fits = (sources["source_id"] == done["source_id"]) & ~stale(cfg)
    return sources.join(done, fits, "left_anti")


def purged(records: DataFrame, source_ids: DataFrame) -> DataFrame:
    """Records of all other sources: what stays when these are processed anew."""
    return records.join(source_ids.select("source_id").distinct(), "source_id", "left_anti")


def replaced(records: DataFrame, fresh: DataFrame) -> DataFrame:
    """fresh in the place of all earlier records of its sources: processing again never doubles a source."""
    return purged(records, fresh).unionByName(fresh, allowMissingColumns=True)


def only_clipping(most_percent: float = 0.1) -> Column:
    """Held for clipping and for nothing else, by less than so many percent of samples."""
    clips = F.exists("review_reasons", lambda r: r.startswith("clipping"))
    alone = F.forall("review_reasons", lambda r: r.startswith("clipping"))
    return F.coalesce(clips & alone & (F.coalesce("clipped_sample_ratio", F.lit(0.0)) * 100 < most_percent), F.lit(False))


def promoted(clips: DataFrame, most_percent: float = 0.1) -> DataFrame:
    """Accepts quarantined clips that are held for slight clipping alone; adds promoted."""
    move = (F.col("status") == "quarantined") & only_clipping(most_percent)
    empty = F.array().cast("array<string>")
    out = clips.withColumn("promoted", move)
    return out.withColumns({"status": F.when(F.col("promoted"), "accepted").otherwise(F.col("status")), "review_reasons": F.when(F.col("promoted"), empty).otherwise(F.col("review_reasons")), "needs_human_review": F.when(F.col("promoted"), False).otherwise(F.col("status") == "quarantined")})


def to_package(files: DataFrame, accepted: DataFrame) -> DataFrame:
    """Files (source_id, utterance_id) of accepted clips; of sources without any accepted id, all."""
    known = accepted.select("source_id").distinct().withColumn("_known", F.lit(True))
    ids = accepted.select("source_id", "utterance_id").distinct().withColumn("_ok", F.lit(True))
    out = files.join(known, "source_id", "left").join(ids, ["source_id", "utterance_id"], "left")
    return out.where("_ok or _known is null").drop("_ok", "_known")


def without_transcript(files: DataFrame, transcripts: DataFrame) -> DataFrame:
    return files.join(transcripts.select("source_id", "utterance_id").distinct(), ["source_id", "utterance_id"], "left_anti")


def to_trim(files: DataFrame, accepted: DataFrame) -> DataFrame:
    """Files of clips that are not accepted; sources without accepted ids are left alone."""
    known = files.join(accepted.select("source_id").distinct(), "source_id", "left_semi")
    return known.join(accepted.select("source_id", "utterance_id").distinct(), ["source_id", "utterance_id"], "left_anti")


def number_stats(clips: DataFrame, language: str = "telugu", style: str = "english", cfg: Config = DEFAULT) -> DataFrame:
    """scanned, with_numbers, changed and numbers_converted."""
    out = with_number_words(clips, language=language, style=style, digitwise=cfg.digitwise_min_len)
    return out.agg(F.count("*").alias("scanned"), F.count_if(F.col("numbers_found") > 0).alias("with_numbers"), F.count_if("changed").alias("changed"), F.coalesce(F.sum("numbers_found"), F.lit(0)).cast("long").alias("numbers_converted"))
