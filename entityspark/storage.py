"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; only where that is unset (tests, local mode) a temporary one."""
    conf = spark.sparkContext.getConf()
    named = conf.get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not named:
        if not conf.get("spark.master", "local").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def scratch_path(spark: SparkSession) -> str:
    """A new name in the shared folder."""
    return f"{shared_dir(spark)}/scratch-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: the lineage ends there, so a lost executor
    costs no more than its own tasks."""
    spark = df.sparkSession
    path = scratch_path(spark)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def release(*frames: DataFrame) -> None:
    """Delete what materialize() wrote for these frames; nothing may read them afterwards."""
    for df in frames:
        if path := getattr(df, "_scratch", None):
            jvm = df.sparkSession.sparkContext._jvm
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def spread(df: DataFrame) -> DataFrame:
    """df dealt to all cores where it comes in fewer splits (a small file), for work that costs much more than reading."""
    n = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= n else df.repartition(n)
