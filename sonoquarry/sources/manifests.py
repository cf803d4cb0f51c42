"""Manifests, caches and states: reading them strictly or leniently, and writing them once."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sonoquarry import schemas
from sonoquarry.storage import exists

STATUSES = ("accepted", "quarantined", "rejected")


def _is_folder(spark: SparkSession, path: str) -> bool:
    """Whether path is a table of this module (a folder of JSON lines), not one or more documents."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return any(x.isDirectory() for x in target.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(target) or [])


def _current(spark: SparkSession, path: str) -> str:
    """path, or its backup if a writer was lost between the renames of `replace_table`."""
    return path if exists(spark, path) or not exists(spark, f"{path}.bak") else f"{path}.bak"


def strict(spark: SparkSession, path: str, schema: str = schemas.CLIP) -> DataFrame:
    """JSON lines; a bad line fails the read, a missing file is empty."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def lenient(spark: SparkSession, path: str, schema: str = schemas.CLIP, keep_bad: bool = False) -> DataFrame:
    """JSON lines without those that don't parse, or with their text in bad_line."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema + (", bad_line STRING" if keep_bad else ""))
    if not keep_bad:
        return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)
    return spark.read.schema(schema + ", bad_line STRING").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "bad_line").json(path)


def all_manifests(spark: SparkSession, root: str, keep_status: bool = True) -> DataFrame:
    """All sources' manifests under root/<source>/manifests/<status>.jsonl, with source and status from the path."""
    out = lenient(spark, f"{root}/*/manifests/*.jsonl")
    if not out.inputFiles():
        return out.withColumn("source", F.lit(None).cast("string"))
    path = F.col("_metadata.file_path")
    out = out.withColumn("source", F.regexp_extract(path, r"([^/]+)/manifests/[^/]+$", 1))
    return out.withColumn("status", F.regexp_extract(path, r"([^/]+)\.jsonl$", 1)) if keep_status else out


def lines(spark: SparkSession, path: str) -> int:
    """Lines that are not blank."""
    return spark.read.text(path).where("trim(value) <> ''").count() if exists(spark, path) else 0


def transcriptions(spark: SparkSession, path: str) -> DataFrame:
    """Cached transcriptions; what can't be parsed is a null row to be made again."""
    return lenient(spark, path, schemas.TRANSCRIPTION, keep_bad=True)


def level_caches(spark: SparkSession, path: str) -> DataFrame:
    return lenient(spark, path, schemas.LEVELS)


def states(spark: SparkSession, path: str) -> DataFrame:
    """States as `write_states` leaves them, or single documents (path may be a pattern); what can't be parsed is no state."""
    path = _current(spark, path)
    if not exists(spark, path) or _is_folder(spark, path):
        return lenient(spark, path, schemas.STATE)
    return spark.read.schema(schemas.STATE).option("mode", "DROPMALFORMED").option("multiLine", "true").json(path)


def speakers(spark: SparkSession, path: str) -> DataFrame:
    """Registered voices in their order: seq, source_id, embedding. From a table or from one document."""
    path = _current(spark, path)
    if not exists(spark, path):
        return spark.createDataFrame([], schemas.VOICE)
    if _is_folder(spark, path):
        return spark.read.schema(schemas.VOICE).json(path)
    return spark.read.schema(schemas.SPEAKERS).option("multiLine", "true").json(path).where("speakers is not null").select(F.posexplode("speakers").alias("seq", "s")).select("seq", "s.source_id", "s.embedding")


def replace_table(rows: DataFrame, path: str) -> None:
    """Writes JSON lines beside path, then renames: a reader finds all of the old table or all of the new one.

    The old table stays as path.bak until the next call. rows may be read from path itself.
    """
    spark = rows.sparkSession
    at = spark._jvm.org.apache.hadoop.fs.Path
    files = at(path).getFileSystem(spark._jsc.hadoopConfiguration())
    part, backup = f"{path}.{uuid.uuid4().hex}.part", f"{path}.bak"
    rows.write.json(part)
    if files.exists(at(path)):
        files.delete(at(backup), True)
        if not files.rename(at(path), at(backup)):
            raise OSError(f"can't move {path} to {backup}")
    if not files.rename(at(part), at(path)):
        raise OSError(f"can't move {part} to {path}")


def write_states(fresh: DataFrame, path: str) -> None:
    """Puts the fresh states in the place of their sources' earlier ones."""
    names = fresh.sparkSession.createDataFrame([], schemas.STATE).columns
    old = states(fresh.sparkSession, path).join(fresh.select("source_id").distinct(), "source_id", "left_anti")
    replace_table(old.select(*names).unionByName(fresh.select(*names)), path)


def write_speakers(voices: DataFrame, path: str) -> None:
    """All registered voices (seq, source_id, embedding), one line each."""
    replace_table(voices.select("seq", "source_id", "embedding"), path)


def write_cache(rows: DataFrame, root: str) -> None:
    """Transcriptions or levels with their source_id: the sources' earlier rows are overwritten, others aren't touched."""
    _overwrite_parts(rows, root, "source_id")


def cached(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """What write_cache left, with source_id."""
    return lenient(spark, root, f"{schema}, source_id STRING")


def _overwrite_parts(rows: DataFrame, root: str, *keys: str) -> None:
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).json(root)


def write_manifests(clips: DataFrame, root: str) -> None:
    """One JSON table of all clips, by source and status; a source's files are overwritten, never doubled."""
    _overwrite_parts(clips, root, "source_id", "status")


def append(clips: DataFrame, path: str) -> None:
    clips.write.mode("append").json(path)


def write_report(report: DataFrame, path: str, kind: str = "csv") -> None:
    """A small ordered report as one file."""
    writer = report.coalesce(1).write.mode("overwrite")
    writer.option("header", "true").csv(path) if kind == "csv" else writer.json(path)


def write_clips(cut: DataFrame, folder: str) -> DataFrame:
    """Writes samples (utterance_id, samples, sample_rate, text) as WAV and text files; returns what was written.

    The folder must be one that all executors share. A task that runs again replaces whole files.
    """
    from pathlib import Path

    from sonoquarry.sources.audio import wav_bytes

    def run(batches):
        import pandas as pd

        for batch in batches:
            rows = []
            for u, x, rate, text in zip(batch["utterance_id"], batch["samples"], batch["sample_rate"], batch["text"], strict=True):
                if x is None:
                    continue
                target = Path(folder)
                target.mkdir(parents=True, exist_ok=True)
                for name, data in ((f"{u}.wav", wav_bytes(x, int(rate))), (f"{u}.txt", (text or "").encode())):
                    part = target / f".{name}.part"
                    part.write_bytes(data)
                    part.replace(target / name)
                rows.append((u, str(target / f"{u}.wav")))
            yield pd.DataFrame(rows, columns=["utterance_id", "audio_path"])

    return cut.select("utterance_id", "samples", "sample_rate", "text").mapInPandas(run, "utterance_id string, audio_path string")
