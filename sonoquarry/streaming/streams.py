"""Streams: windows over level traces, sessions of speech, resumable intake, the speaker registry."""

from __future__ import annotations

from collections import deque
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from sonoquarry.config import DEFAULT, Config
from sonoquarry.operators.speakers import registered
from sonoquarry.storage import exists, saved


def timed(events: DataFrame, ts: str = "ts", late: str = "10 minutes") -> DataFrame:
    """With an event-time column that a watermark accepts."""
    return events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)


def tumbling(events: DataFrame, width: str, *keys: str, ts: str = "ts", value: str = "value") -> DataFrame:
    out = events.groupBy(F.window(ts, width).alias("w"), *keys).agg(F.count("*").alias("n"), F.sum(value).alias("total"))
    return out.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *keys, "n", "total")


def sliding(events: DataFrame, width: str, hop: str, *keys: str, ts: str = "ts", value: str = "value") -> DataFrame:
    out = events.groupBy(F.window(ts, width, hop).alias("w"), *keys).agg(F.count("*").alias("n"), F.sum(value).alias("total"))
    return out.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *keys, "n", "total")


def sessions(events: DataFrame, gap: str, *keys: str, ts: str = "ts") -> DataFrame:
    """Stretches without a pause as long as the gap."""
    out = events.groupBy(F.session_window(ts, gap).alias("w"), *keys).agg(F.count("*").alias("n"))
    return out.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *keys, "n")


def intake(spark: SparkSession, folder: str, schema: str, kind: str = "parquet") -> DataFrame:
    """Files that arrive in a folder, each read once; the checkpoint of the query remembers which."""
    return spark.readStream.format(kind).schema(schema).load(folder)


def run_available(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None]) -> None:
    """Processes what has arrived and ends; started again, it goes on where it stopped."""
    stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def speaker_registry(folder: str, cfg: Config = DEFAULT) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that decides new voices (seq, source_id, embedding) against a registry.

    Voices of earlier batches come first, whatever their numbers; within a batch the order is seq. Each new
    voice meets all registered ones, and the new ones each other; registered ones are not compared again.
    The registry is one Parquet folder with a partition for each batch, replaced as a whole, so a batch
    that runs again has the same effect; matched_batch and matched_seq name the voice that was met.
    """
    schema = "seq long, source_id string, embedding array<float>, decision string, matched_batch long, matched_seq long, similarity double, batch long"

    def each(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        new = saved(batch.select(F.col("seq").cast("long").alias("seq"), "source_id", F.col("embedding").cast("array<float>").alias("embedding")))
        known = names = None
        if exists(spark, f"{folder}/batch=*"):
            held = spark.read.schema(schema).option("basePath", folder).parquet(folder).where((F.col("batch") < number) & (F.col("decision") != "duplicate"))
            # Numbers in the order of registration, for the comparison alone.
            order = F.row_number().over(Window.orderBy("batch", "seq")).cast("long")
            names = saved(held.withColumn("_n", order).select("batch", F.col("seq").alias("of"), F.col("_n").alias("seq"), "embedding"))
            known = names.select("seq", "embedding")
        decided = registered(new, cfg, known)
        if known is None:
            decided = decided.withColumn("matched_batch", F.when(F.col("matched_seq").isNotNull(), F.lit(number).cast("long")))
        else:
            of = names.select(F.col("seq").alias("_k"), F.col("batch").alias("_batch"), F.col("of").alias("_of"))
            decided = decided.join(of, F.col("matched_known") & (F.col("matched_seq") == F.col("_k")), "left")
            decided = decided.withColumn("matched_batch", F.coalesce("_batch", F.when(F.col("matched_seq").isNotNull(), F.lit(number).cast("long")))).withColumn("matched_seq", F.coalesce("_of", "matched_seq"))
        decided.select(*[f.split()[0] for f in schema.split(", ")[:-1]]).write.mode("overwrite").parquet(f"{folder}/batch={number}")

    return each


class Progress(StreamingQueryListener):
    """Keeps a line for each finished micro-batch of all queries: name, batch, rows in and seconds."""

    def __init__(self, keep: int = 1000) -> None:
        self.lines: deque[tuple[str, int, int, float]] = deque(maxlen=keep)
        self.ended: list[tuple[str, str | None]] = []

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        self.lines.append((p.name or str(p.id), p.batchId, p.numInputRows, p.batchDuration / 1000))

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self.ended.append((str(event.id), event.exception))
