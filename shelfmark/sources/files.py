"""Reports and listings as files: CSV with a byte order mark, text, JSON, snapshots by date, physical files."""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.functions.text import date_key
from shelfmark.schemas import BASENAME_REPAIR, ENCODE_REPAIR, TITLE_REPAIR


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def read_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """An edited report: all columns as text, quoted line ends kept, in the order of the header; a missing file is empty."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    raw = spark.read.csv(path, header=True, multiLine=True, escape='"', inferSchema=False)
    return raw.select(*[F.col(c) if c in raw.columns else F.lit(None).cast("string").alias(c) for c in columns])


def _number(c: str) -> F.Column:
    return F.col(c).try_cast("bigint")


def read_encode_repairs(spark: SparkSession, path: str) -> DataFrame:
    """The deletions of an edited report of garbled values: ``table, column, row_id, book_id, value, init_path``.

    Only rows with status delete_file count. The book is the one named, else the one in the repaired text (``book_id=N``), else the row itself.
    """
    raw = read_csv(spark, path, ENCODE_REPAIR).where("status = 'delete_file'")
    noted = F.regexp_extract(F.coalesce("repaired", F.lit("")), r"book_id=(\d+)", 1).try_cast("bigint")
    return raw.select("table", "column", _number("row_id").alias("row_id"), F.coalesce(_number("book_id"), noted, _number("row_id")).alias("book_id"), "value", F.coalesce("init_path", F.lit("")).alias("init_path"))


def read_title_repairs(spark: SparkSession, path: str) -> DataFrame:
    """An edited report of title repairs, typed; rows without a book are left out."""
    raw = read_csv(spark, path, TITLE_REPAIR)
    return raw.withColumn("book_id", _number("book_id")).where("book_id is not null").withColumnRenamed("title_candidate", "candidate")


def read_basename_repairs(spark: SparkSession, path: str) -> DataFrame:
    """An edited report of base-name repairs, typed; rows without a file are left out."""
    raw = read_csv(spark, path, BASENAME_REPAIR)
    return raw.withColumn("book_id", _number("book_id")).withColumn("data_id", _number("data_id")).where("data_id is not null").withColumnRenamed("file_basename_candidate", "candidate")


def snapshot(df: DataFrame, path: str, by: dict[str, str], **more: int) -> dict:
    """Writes totals as JSON: ``total``, and for each name in ``by`` the counts of a column's values. Columns of few values only."""
    out: dict = {"total": df.count(), **more}
    for name, column in by.items():
        out[name] = {str(r[0]): r[1] for r in df.groupBy(F.coalesce(F.col(column).cast("string"), F.lit(""))).count().collect()}
    write_json(out, path)
    return out


def require(spark: SparkSession, paths: dict[str, str]) -> None:
    """Raises with the names of all inputs that are missing."""
    gone = [f"{n}: {p}" for n, p in paths.items() if not exists(spark, p)]
    if gone:
        raise FileNotFoundError("missing " + "; ".join(gone))


def write_csv(df: DataFrame, path: str, columns: list[str], order: list[str] | None = None) -> None:
    """A report as a folder of CSV parts with header; missing columns and nulls are empty. Sorted if an order is given."""
    out = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in df.columns else F.lit("").alias(c) for c in columns])
    if order:
        out = out.orderBy(*order)
    out.write.mode("overwrite").csv(path, header=True, escape='"', emptyValue="")


def write_bom_csv(df: DataFrame, path: str, columns: list[str]) -> int:
    """One CSV file with a byte order mark on the driver's disk, streamed row by row; for people's spreadsheets."""
    import csv

    n = 0
    with open(path, "w", encoding="utf-8-sig", newline="") as f:
        w = csv.writer(f)
        w.writerow(columns)
        for r in df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")) if c in df.columns else F.lit("") for c in columns]).toLocalIterator():
            w.writerow(list(r))
            n += 1
    return n


def write_by_reason(df: DataFrame, path: str, columns: list[str], reasons: list[str], key: str = "reason_code") -> None:
    """A report per reason in ``path/<key>=<reason>``, in one pass over the rows; a reason without rows has no folder and is read as empty."""
    out = df.where(F.col(key).isin(reasons)).select(F.col(key).alias("_reason"), *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in df.columns else F.lit("").alias(c) for c in columns])
    out.withColumnRenamed("_reason", f"{key}_" if key in columns else key).write.mode("overwrite").partitionBy(f"{key}_" if key in columns else key).csv(path, header=True, escape='"', emptyValue="")


def write_text(lines: DataFrame, path: str, line: str = "line", order: str = "seq") -> None:
    """Lines in order as text parts."""
    lines.orderBy(order).select(line).write.mode("overwrite").text(path)


def write_json(values: dict, path: str) -> None:
    with open(path, "w", encoding="utf-8") as f:
        json.dump(values, f, ensure_ascii=False, indent=2, sort_keys=True)


def latest(names: list[str]) -> str | None:
    """The snapshot with the latest date in its name."""
    import re

    dated = [(m[1], n) for n in names if (m := re.search(r"metadata-(?:full-)?(\d{8})", os.path.basename(n)))]
    return max(dated)[1] if dated else None


def first_existing(spark: SparkSession, paths: list[str]) -> str | None:
    """First path of a list in order of preference that exists, on any file system."""
    return next((p for p in paths if exists(spark, p)), None)


def with_batch(df: DataFrame) -> DataFrame:
    """Adds the batch of the snapshot file each row comes from."""
    return df.withColumn("batch", date_key(F.input_file_name()))


def listing(spark: SparkSession, root: str) -> DataFrame:
    """``relative_path, actual_bytes`` of all files below a folder; contents are not read."""
    base = os.path.abspath(root)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(base).select("path", "length")
    return files.select(F.regexp_replace(F.regexp_replace("path", r"^file:/*", "/"), f"^{base}/", "").alias("relative_path"), F.col("length").alias("actual_bytes"))


def row_image(df: DataFrame, name: str = "json") -> DataFrame:
    """Adds the row as JSON with sorted keys, nulls kept."""
    return df.withColumn(name, F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}))
