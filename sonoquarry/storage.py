"""Durable tables between the steps of a plan, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session; a folder of its own only where the whole session is one machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        context = spark.sparkContext._jsc.sc().getCheckpointDir()
        if context.isDefined():
            folder = context.get()
        elif spark.sparkContext.master.startswith("local") and not spark.sparkContext.master.startswith("local-cluster"):
            folder = tempfile.mkdtemp(prefix="sonoquarry-")
            spark.sparkContext.setCheckpointDir(folder)
        else:
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    return folder.rstrip("/")


def saved(df: DataFrame) -> DataFrame:
    """df as a Parquet table in the shared folder: cuts the lineage, and outlives lost executors."""
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether anything lies under a path or pattern, by Spark's own file systems."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(target)
    return found is not None and len(found) > 0


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """df, dealt by its keys over the session's cores if it comes in fewer partitions, as one small file does."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if df.rdd.getNumPartitions() < cores else df
