"""Tables stored by buckets of their key, so that an insert or update reads and writes only the buckets it touches.

Layout: path/bucket=b/*.parquet, for tables that batches append to path/bucket=b/batch=name/*.parquet, and an empty file
_buckets-N that holds the number of buckets. A bucket is xxhash64 of the key modulo N; N is chosen so that one bucket is
a task's work, as files can't be moved between buckets later.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from entityspark.sources.tables import first_of, upsert


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def bucket_count(spark: SparkSession, path: str) -> int | None:
    """N of a table, None where there is none yet."""
    where, fs = _fs(spark, path)
    names = [f.getPath().getName() for f in fs.listStatus(where)] if fs.exists(where) else []
    return next((int(n.removeprefix("_buckets-")) for n in names if n.startswith("_buckets-")), None)


def create(spark: SparkSession, path: str, buckets: int) -> int:
    """N of the table, which is made if it isn't there."""
    if (have := bucket_count(spark, path)) is not None:
        return have
    marker, fs = _fs(spark, f"{path}/_buckets-{buckets}")
    fs.create(marker, True).close()
    return buckets


def bucket_of(key: list[str], n: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(n)).cast("int")


def stored(spark: SparkSession, path: str, schema, buckets: list[int] | None = None) -> DataFrame:
    """The table's rows with bucket and batch (null where batches are not kept), of some buckets or all. Only the
    folders of these buckets are listed and read."""
    where, fs = _fs(spark, path)
    names = [f.getPath().getName() for f in fs.listStatus(where)] if fs.exists(where) else []
    have = [n for n in names if n.startswith("bucket=") and (buckets is None or int(n[7:]) in buckets)]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    if not have:
        return spark.createDataFrame([], fields + ", bucket int, batch string")
    return spark.read.schema(fields + ", bucket int, batch string").option("basePath", path).parquet(*(f"{path}/{n}" for n in sorted(have)))


def read(spark: SparkSession, path: str, schema) -> DataFrame:
    return stored(spark, path, schema).drop("bucket", "batch")


def _write(d: DataFrame, path: str, by: list[str]) -> None:
    (d.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path))


def _touched(d: DataFrame) -> list[int]:
    """At most N numbers."""
    return sorted(r[0] for r in d.select("bucket").distinct().collect())


def insert_batch(new: DataFrame, path: str, key: list[str], order: list[str], batch: str, buckets: int = 64) -> None:
    """Add the rows whose key is not stored yet, of equal keys the first in order; null keys are never stored.

    The batch's files stand under its name, and it is held against the other batches of its own buckets: run again after
    a failure, wherever that came, it replaces what it wrote by the same rows.
    """
    spark = new.sparkSession
    n = create(spark, path, buckets)
    first = first_of(new, key, order).withColumn("bucket", bucket_of(key, n))
    known = stored(spark, path, new.schema, _touched(first)).where(F.col("batch") != batch)
    _write(first.join(known.select(*key), key, "left_anti").select(*new.columns, "bucket").withColumn("batch", F.lit(batch)), path, ["bucket", "batch"])


def upsert_into(new: DataFrame, path: str, key: list[str], update: list[str], buckets: int = 64) -> None:
    """On a known key the listed columns change, new keys are added; one row a key. Files of other buckets stay."""
    spark = new.sparkSession
    n = create(spark, path, buckets)
    new = new.withColumn("bucket", bucket_of(key, n))
    old = stored(spark, path, new.drop("bucket").schema, _touched(new)).drop("batch", "bucket")
    _write(upsert(new.drop("bucket"), old, key, update).withColumn("bucket", bucket_of(key, n)), path, ["bucket"])
