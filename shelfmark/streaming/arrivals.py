"""Batches as they arrive: the streaming forms of deduplication and counting."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def arrivals(spark: SparkSession, path: str, schema: StructType, files_per_trigger: int = 100) -> DataFrame:
    """A folder of Parquet files as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def _timed(stream: DataFrame, stamp: str) -> DataFrame:
    """Event time as Spark's watermarks want it; times without a zone are read in the session's."""
    return stream.withColumn(stamp, F.col(stamp).cast("timestamp"))


def first_arrivals(stream: DataFrame, keys: list[str], stamp: str, delay: str = "30 days") -> DataFrame:
    """The first row of each key; a repeat later than the delay counts anew, so the state stays bounded."""
    return _timed(stream, stamp).withWatermark(stamp, delay).dropDuplicatesWithinWatermark(keys)


def windowed_counts(stream: DataFrame, stamp: str, by: list[str], width: str = "14 days", delay: str = "30 days") -> DataFrame:
    """``start, by, n`` per window of event time; rows later than the delay are dropped, as the watermark defines."""
    return _timed(stream, stamp).withWatermark(stamp, delay).groupBy(F.window(stamp, width), *by).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), *by, "n")


def each_batch(stream: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str, name: str | None = None) -> StreamingQuery:
    """Runs a batch step, such as an append to a table, on each arrival; offsets live in the checkpoint folder."""
    w = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    return (w.queryName(name) if name else w).start()
