"""Audio files as tables: listing, folder plans, header probes, samples and clip cuts.

Only paths, offsets and features move between stages; samples are read where they are needed.
"""

from __future__ import annotations

import io
import wave
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# File endings taken for audio.
EXTENSIONS = ("wav", "mp3", "flac", "m4a", "ogg", "aac", "wma", "opus")


def is_audio(path: Column) -> Column:
    return path.rlike(rf"(?i)\.({'|'.join(EXTENSIONS)})$")


def listing(spark: SparkSession, folder: str, recursive: bool = False) -> DataFrame:
    """path, size, mtime, name, stem and folder of the audio files, contents unread."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(folder)
    return named(files.select("path", F.col("length").alias("size"), F.col("modificationTime").cast("double").alias("mtime"))).where(is_audio(F.col("path")))


def named(files: DataFrame) -> DataFrame:
    name = F.element_at(F.split("path", "/"), -1)
    return files.withColumns({"name": name, "stem": F.regexp_replace(name, r"\.[^.]*$", ""), "folder": F.coalesce(F.get(F.split("path", "/"), F.size(F.split("path", "/")) - 2), F.lit(""))})


def folder_plan(files: DataFrame, output: str | None = None, only: list[str] | None = None) -> DataFrame:
    """folder and audio_files: hidden folders and the output folder are left out."""
    keep = ~F.col("folder").startswith(".")
    if output is not None:
        keep = keep & (F.col("folder") != output)
    if only:
        keep = keep & F.col("folder").isin(only)
    return files.where(keep).groupBy("folder").agg(F.count("*").alias("audio_files"))


def planned(plan: DataFrame, direct: DataFrame, root_name: str) -> DataFrame:
    """The folder plan, or the root as its one folder if there is none but files lie in the root itself."""
    if not plan.isEmpty():
        return plan
    return direct.agg(F.count("*").alias("audio_files")).where("audio_files > 0").select(F.lit(root_name).alias("folder"), "audio_files")


def with_keys(files: DataFrame) -> DataFrame:
    """Adds source_id: the folder's name, with _2, _3 ... for its further files in path order."""
    n = F.row_number().over(Window.partitionBy("folder").orderBy("path"))
    return files.withColumn("_n", n).withColumn("source_id", F.when(F.col("_n") == 1, F.col("folder")).otherwise(F.concat("folder", F.lit("_"), F.col("_n").cast("string")))).drop("_n")


def limited(files: DataFrame, per_folder: int) -> DataFrame:
    return files.withColumn("_n", F.row_number().over(Window.partitionBy("folder").orderBy("path"))).where(F.col("_n") <= per_folder).drop("_n")


def _wave(content: bytes) -> tuple[np.ndarray, int]:
    with wave.open(io.BytesIO(content)) as f:
        if f.getsampwidth() != 2:
            raise wave.Error("only 16 bit")
        data = np.frombuffer(f.readframes(f.getnframes()), "<i2").reshape(-1, f.getnchannels())
        return data.astype(np.float64) / 32768, f.getframerate()


PROBE = "path string, codec string, channels int, sample_rate int, bits_per_sample int, duration_sec double, size_bytes long, has_audio_stream boolean, probe_ok boolean, error string"


def probed(files: DataFrame) -> DataFrame:
    """Header facts of WAV files (path, content); a file that can't be read has probe_ok = false and an error."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path, content in zip(batch["path"], batch["content"], strict=True):
                try:
                    with wave.open(io.BytesIO(content)) as f:
                        rate = f.getframerate()
                        rows.append((path, "pcm", f.getnchannels(), rate, 8 * f.getsampwidth(), f.getnframes() / rate if rate else 0.0, len(content), True, True, None))
                except (wave.Error, EOFError) as e:
                    rows.append((path, None, None, None, None, None, len(content), False, False, str(e) or "unreadable"))
            yield pd.DataFrame(rows, columns=[x.split()[0] for x in PROBE.split(", ")])

    return files.select("path", "content").mapInPandas(run, PROBE)


def levels(files: DataFrame, block_sec: float = 1.0, silence_dbfs: float = -45.0, clip_amplitude: float = 0.998) -> DataFrame:
    """One pass over each file: whole levels and the trace of block levels."""
    schema = "path string, duration_sec double, sample_rate int, rms_dbfs double, peak_dbfs double, clipped_sample_ratio double, silence_ratio double, block_rms_dbfs array<double>, block_hop_sec double, n_samples long"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        db = lambda x: 20 * np.log10(np.maximum(x, 1e-9))
        for batch in batches:
            rows = []
            for path, content in zip(batch["path"], batch["content"], strict=True):
                x, rate = _wave(content)
                x = x.mean(axis=1)
                hop = int(rate * block_sec)
                blocks = [float(db(np.sqrt(np.mean(x[k : k + hop] ** 2) + 1e-12))) for k in range(0, len(x), hop)]
                n = max(1, len(x))
                rows.append((path, len(x) / rate, rate, float(db(np.sqrt((x**2).sum() / n + 1e-12))), float(db(np.abs(x).max(initial=0))), float((np.abs(x) >= clip_amplitude).sum() / n), float(np.mean([b < silence_dbfs for b in blocks])) if blocks else 0.0, blocks, block_sec, len(x)))
            yield pd.DataFrame(rows, columns=[c.strip().split()[0] for c in schema.split(", ")])

    return files.select("path", "content").mapInPandas(run, schema)


def cuts(clips: DataFrame, files: DataFrame) -> DataFrame:
    """Adds samples, sample_rate and cut_error to clips (path and spans array<struct<start, end>>).

    Spans are cut to the file; empty ones are skipped; if nothing is left that is an error.
    """
    joined = clips.join(files.select("path", "content"), "path")
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in clips.schema)}, samples array<float>, sample_rate int, cut_error string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for content, spans in zip(batch["content"], batch["spans"], strict=True):
                try:
                    x, rate = _wave(content)
                    x = x.mean(axis=1)
                    parts = [x[max(0, int(s["start"] * rate)) : min(len(x), int(s["end"] * rate))] for s in spans]
                    parts = [p for p in parts if len(p)]
                    out.append((np.concatenate(parts).astype(np.float32), rate, None) if parts else (None, rate, "no audio in spans"))
                except (wave.Error, EOFError) as e:
                    out.append((None, None, str(e) or "unreadable"))
            batch = batch[[c for c in batch.columns if c != "content"]].copy()
            batch["samples"], batch["sample_rate"], batch["cut_error"] = zip(*out, strict=True) if out else ([], [], [])
            batch["sample_rate"] = batch["sample_rate"].astype("Int32")
            yield batch

    return joined.select(*clips.columns, "content").mapInPandas(run, schema)


def wav_bytes(samples: np.ndarray, rate: int) -> bytes:
    """PCM16, one channel."""
    out = io.BytesIO()
    with wave.open(out, "wb") as f:
        f.setnchannels(1)
        f.setsampwidth(2)
        f.setframerate(rate)
        f.writeframes((np.clip(np.asarray(samples, np.float64), -1, 1) * 32767).astype("<i2").tobytes())
    return out.getvalue()
