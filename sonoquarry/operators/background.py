"""Levels and background: block traces, file levels, noise floor, and the verdict on a clip."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sonoquarry.config import DEFAULT, Config
from sonoquarry.functions.text import fixed
from sonoquarry.functions.vectors import dbfs


def file_levels(samples: DataFrame, cfg: Config = DEFAULT, key: str = "source_id", value: str = "x") -> DataFrame:
    """RMS, peak and clipped share per recording; all are partial aggregates."""
    x = F.col(value)
    return samples.groupBy(key).agg(
        F.count("*").alias("n_samples"), dbfs(F.sqrt(F.sum(x * x) / F.count("*") + 1e-12)).alias("rms_dbfs"), dbfs(F.max(F.abs(x))).alias("peak_dbfs"),
        F.avg(F.when(F.abs(x) >= cfg.clip_amplitude, 1.0).otherwise(0.0)).alias("clipped_sample_ratio"),
    )


def block_levels(samples: DataFrame, hop: int, key: str = "source_id", pos: str = "i", value: str = "x") -> DataFrame:
    """Level of each run of `hop` samples; the last one may be short."""
    x = F.col(value)
    return samples.groupBy(key, F.floor(F.col(pos) / hop).alias("block")).agg(dbfs(F.sqrt(F.avg(x * x) + 1e-12)).alias("dbfs"), F.count("*").alias("n"))


def silence_ratio(blocks: DataFrame, cfg: Config = DEFAULT, key: str = "source_id") -> DataFrame:
    return blocks.groupBy(key).agg(F.avg(F.when(F.col("dbfs") < cfg.silence_block_dbfs, 1.0).otherwise(0.0)).alias("silence_ratio"))


def noise_floor(blocks: DataFrame, regions: DataFrame, cfg: Config = DEFAULT, key: str = "source_id") -> DataFrame:
    """noise_floor_dbfs and speech_level_dbfs per recording. regions: key and an array `regions` of (start, end), ends included.

    Blocks outside speech give the floor and blocks inside the level; where there are none, all blocks do.
    """
    out = blocks.join(regions, key, "left")
    speech = F.coalesce(F.exists("regions", lambda r: (F.col("t") >= r["start"]) & (F.col("t") <= r["end"])), F.lit(False))
    out = out.withColumn("_in", speech)
    at = lambda value, p: F.percentile(value, F.lit(p))
    floor = F.coalesce(at(F.when(~F.col("_in"), F.col("dbfs")), cfg.noise_percentile), at("dbfs", cfg.noise_percentile))
    level = F.coalesce(at(F.when(F.col("_in"), F.col("dbfs")), cfg.speech_percentile), at("dbfs", cfg.speech_percentile))
    return out.groupBy(key).agg(floor.alias("noise_floor_dbfs"), level.alias("speech_level_dbfs"))


def clip_levels(frames: DataFrame, key: str = "utterance_id") -> DataFrame:
    """Per clip: speech level, its own noise floor, and mean spectral flatness. frames have dbfs and flatness."""
    return frames.groupBy(key).agg(F.percentile("dbfs", F.lit(0.75)).alias("speech_level_dbfs"), F.percentile("dbfs", F.lit(0.10)).alias("clip_floor_dbfs"), F.avg("flatness").alias("flatness"))


def background_verdict(clips: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Adds est_snr_db, background_verdict and background_reasons.

    clips: speech_level_dbfs, clip_floor_dbfs, flatness, file_floor_dbfs (null where unknown), and empty if
    there may be clips without samples, which are rejected. A low ratio or tonal sound counts only with a
    floor that is high for the file and loud in itself.
    """
    own, of_file = F.col("clip_floor_dbfs"), F.col("file_floor_dbfs")
    nothing = F.coalesce("empty", F.lit(False)) if "empty" in clips.columns else F.lit(False)
    raised: Column = F.coalesce((own > of_file + 12.0) & (own > -50.0), F.lit(False))
    snr = F.when(nothing, 0.0).otherwise(F.col("speech_level_dbfs") - F.coalesce(of_file, own))
    out = clips.withColumns({"est_snr_db": snr, "_raised": raised})
    low = (F.col("est_snr_db") < cfg.snr_reject_db) & F.col("_raised")
    music, broad = F.col("_raised") & (F.col("flatness") < cfg.music_flatness), F.col("_raised") & (F.col("flatness") > cfg.broadband_flatness)
    tonal_or_broad = F.array_compact(F.array(F.when(music, "elevated_noise_floor_with_tonal_content_suggests_background_music"), F.when(broad, "elevated_noise_floor_with_broadband_content_suggests_noise_or_crowd")))
    weak = F.array(F.concat(F.lit("estimated_snr_"), fixed(F.col("est_snr_db"), 1), F.lit("dB_with_elevated_noise_floor")))
    reasons = F.when(nothing, F.array(F.lit("empty_audio"))).when(low, weak).otherwise(tonal_or_broad)
    verdict = F.when(nothing | low, "reject").when(music | broad, "review").otherwise("clean")
    return out.withColumns({"background_verdict": verdict, "background_reasons": reasons}).drop("_raised")


def gain(clips: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Adds gain_db, gain and output_lufs to clips with input_lufs and peak: limited both in gain and at the peak."""
    want = F.greatest(F.lit(-cfg.max_gain_db), F.least(F.lit(cfg.max_gain_db), cfg.target_lufs - F.col("input_lufs")))
    heard = F.col("input_lufs").isNotNull() & (F.col("input_lufs") > float("-inf"))
    linear = F.pow(F.lit(10.0), want / 20)
    peak = F.col("peak") * linear
    safe = F.when(peak > cfg.peak_ceiling, cfg.peak_ceiling / peak).otherwise(F.lit(1.0))
    out = clips.withColumn("gain_db", F.when(heard, want + 20 * F.log10(safe)).otherwise(F.lit(0.0)))
    return out.withColumns({"loudness_applied": heard, "gain": F.pow(F.lit(10.0), F.col("gain_db") / 20), "output_lufs": F.col("input_lufs") + F.col("gain_db")})
