"""Stable identifiers and surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.functions.text import blank

#: Fixed value: the name space for URLs of RFC 4122.
NAMESPACE_URL = "6ba7b8119dad11d180b400c04fd430c8"


def stable_id(*parts: Column | str) -> Column:
    """First 16 hex digits of the SHA-1 of the parts joined by |; null counts as empty."""
    return F.substring(F.sha1(F.encode(F.concat_ws("|", *[blank(p) for p in parts]), "UTF-8")), 1, 16)


def sync_id(*parts: Column | str) -> Column:
    """First 16 hex digits of the name-based (SHA-1) UUID of the parts joined by |."""
    h = F.sha1(F.concat(F.unhex(F.lit(NAMESPACE_URL)), F.encode(F.concat_ws("|", *[blank(p) for p in parts]), "UTF-8")))
    return F.concat(F.substring(h, 1, 12), F.lit("5"), F.substring(h, 14, 3))


def random_id() -> Column:
    """A random identifier for a new row; it differs from run to run, so nothing may depend on it."""
    return F.expr("uuid()")


def with_surrogate(df: DataFrame, name: str, order: list[str], start: int = 0, partitions: int | None = None) -> DataFrame:
    """Adds consecutive ids from start + 1 in the given order.

    Rows are range-partitioned and numbered per range; only one offset per range passes through a
    single task, never the rows. Rows equal in every order column are numbered in an unspecified order among
    themselves. An empty input stays empty.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id())
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    offsets = sizes.select("_part", (F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.lit(start)).alias("_off"))
    local = ranged.withColumn("_rn", F.row_number().over(Window.partitionBy("_part").orderBy(*order)))
    return local.join(F.broadcast(offsets), "_part").withColumn(name, (F.col("_off") + F.col("_rn")).cast("bigint")).drop("_part", "_rn", "_off")
