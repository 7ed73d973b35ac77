"""Incremental ingest of append-only listing logs."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from entityspark.sources import keyed


def ingest(spark: SparkSession, log: str, schema: str, flatten: Callable[[DataFrame], DataFrame], table: str, checkpoint: str, key: list[str], order: list[str], buckets: int = 64) -> StreamingQuery:
    """Every new log file, flattened, into a keyed table (sources.keyed): only keys not stored yet.

    A batch writes under a name made of its stream and number and is held against its own key buckets only. A batch
    that failed, even half-written, and runs again replaces its files. Ends when all files present are taken.
    """
    stream_name = hashlib.md5(checkpoint.encode()).hexdigest()[:8]

    def store(batch: DataFrame, number: int) -> None:
        keyed.insert_batch(flatten(batch), table, key, order, f"{stream_name}-{number}", buckets)

    stream = spark.readStream.schema(schema).json(log)
    return stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def bounded_dedup(stream: DataFrame, time: str, key: list[str], delay: str) -> DataFrame:
    """One row per key within the delay; later repeats may pass, so a sink still has to check its table."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(key)
