"""A library: named relations, read from and written to a directory of Parquet files, or from any JDBC database."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.schemas import library_schema, LIBRARY

#: What may name a relation or column in generated text.
IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_]*\Z")


def identifier(name: str) -> str:
    if not IDENTIFIER.match(name):
        raise ValueError(f"not an identifier: {name!r}")
    return name


class Library(Mapping[str, DataFrame]):
    """Immutable mapping of relation names to DataFrames; every change gives a new Library."""

    def __init__(self, tables: Mapping[str, DataFrame]) -> None:
        self._tables = dict(tables)

    def __getitem__(self, name: str) -> DataFrame:
        return self._tables[name]

    def __iter__(self):
        return iter(self._tables)

    def __len__(self) -> int:
        return len(self._tables)

    def replace(self, **tables: DataFrame) -> Library:
        return Library(self._tables | tables)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Library:
        """Every <name>.parquet under the path."""
        fs_path = spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = fs_path.getFileSystem(spark._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in fs.listStatus(fs_path)]
        return cls({n[: -len(".parquet")]: spark.read.parquet(f"{path}/{n}") for n in sorted(names) if n.endswith(".parquet")})

    @classmethod
    def from_jdbc(cls, spark: SparkSession, url: str, names: list[str] | None = None, **options: str) -> Library:
        """Relations of a database (SQLite and others, with their driver on the class path)."""
        return cls({n: spark.read.format("jdbc").options(url=url, dbtable=identifier(n), **options).load() for n in names or LIBRARY})

    def save(self, path: str) -> None:
        """Writes each relation; readers of an older path are not disturbed."""
        for n, df in self.items():
            df.write.mode("overwrite").parquet(f"{path}/{n}.parquet")

    def get_or_empty(self, spark: SparkSession, name: str) -> DataFrame:
        """The relation, or an empty one of its schema."""
        return self._tables[name] if name in self._tables else spark.createDataFrame([], library_schema(name))

    @property
    def usable(self) -> bool:
        return {"books", "data"} <= set(self)

    def children(self) -> list[str]:
        """Relations that hang on a book."""
        return sorted(n for n, df in self.items() if "book" in df.columns)

    def counts(self) -> dict[str, int]:
        return {n: df.count() for n, df in self.items()}

    def book_files(self) -> DataFrame:
        """Books with their files: ``book_id, title, book_path, data_id, format, file_basename, bytes``."""
        b, d = self["books"], self["data"]
        return b.join(d, d["book"] == b["id"]).select(b["id"].alias("book_id"), b["title"], b["path"].alias("book_path"), d["id"].alias("data_id"), d["format"], d["name"].alias("file_basename"), d["uncompressed_size"].alias("bytes"))

    def init_paths(self, column: str = "custom_column_1") -> DataFrame:
        """``book, init_path``: a book's source paths, sorted, distinct, joined by '; '. Either shape of the custom column; without it no rows.

        One row per book, so a join on it never multiplies files.
        """
        if column not in self:
            return self["books"].select(F.col("id").alias("book"), F.lit("").alias("init_path")).limit(0)
        c = self[column]
        if "book" in c.columns:
            pairs = c.select("book", "value")
        else:
            link = self[f"books_{column}_link"]
            pairs = link.join(c, link["value"] == c["id"]).select(link["book"], c["value"].alias("value"))
        paths = pairs.select("book", F.trim("value").alias("value")).where("value <> ''")
        return paths.groupBy("book").agg(F.array_join(F.array_sort(F.collect_set("value")), "; ").alias("init_path"))

    def dedup_records(self) -> DataFrame:
        """Files with their normal relative path and source paths; null size 0, null texts empty, lower-case ext."""
        f = self.book_files().join(self.init_paths().withColumnRenamed("book", "book_id"), "book_id", "left")
        return f.select("book_id", "data_id", F.coalesce("title", F.lit("")).alias("title"), F.coalesce("bytes", F.lit(0)).cast("bigint").alias("bytes"), F.coalesce("init_path", F.lit("")).alias("init_path"), relative_path("book_path", "file_basename", "format").alias("relative_path"), F.lower(F.trim(F.coalesce("format", F.lit("")))).alias("ext"))

    def found_files(self, listing: DataFrame, batch: str | None = None) -> DataFrame:
        """Files with source paths and what was found on disk: ``batch, book_id, data_id, title, file_basename, ext, bytes, relative_path, custom_column_1_value,
        file_exists, actual_bytes``. listing: ``relative_path, actual_bytes``; of a repeated path the greatest size counts."""
        paths = self.init_paths().withColumnRenamed("book", "book_id").withColumnRenamed("init_path", "custom_column_1_value")
        files = self.book_files().join(paths, "book_id", "left").withColumn("relative_path", relative_path("book_path", "file_basename", "format"))
        disk = listing.groupBy(F.col("relative_path").alias("_p")).agg(F.max("actual_bytes").alias("actual_bytes"))
        j = files.join(disk, F.col("relative_path") == F.col("_p"), "left")
        return j.select(F.lit(batch).cast("string").alias("batch"), "book_id", "data_id", "title", "file_basename", F.lower(F.trim(F.coalesce("format", F.lit("")))).alias("ext"), "bytes", "relative_path", F.coalesce("custom_column_1_value", F.lit("")).alias("custom_column_1_value"), F.col("_p").isNotNull().alias("file_exists"), "actual_bytes")

    def copy(self, path: str, spark: SparkSession) -> Library:
        """A library without history starts as a copy of this one at the path."""
        self.save(path)
        return Library.load(spark, path)

    def delete(self, data_ids: DataFrame, book_ids: DataFrame | None = None) -> Library:
        """Without the files whose ``id`` is named and the books named, and without what hangs on no book any more.

        A named book that keeps a file stays. Without book_ids every book whose last file goes, goes.
        """
        data = self["data"].join(data_ids.select(F.col("id").alias("_id")).distinct(), F.col("id") == F.col("_id"), "left_anti")
        left = data.select(F.col("book").alias("_b")).where("_b is not null").distinct()
        had = self["data"].join(data_ids.select(F.col("id").alias("_id")).distinct(), F.col("id") == F.col("_id"), "left_semi").select(F.col("book").alias("id"))
        named = had if book_ids is None else book_ids.select("id")
        gone = named.distinct().join(left, F.col("id") == F.col("_b"), "left_anti").withColumnRenamed("id", "_gone")
        books = self["books"].join(gone, F.col("id") == F.col("_gone"), "left_anti")
        out = self.replace(books=books, data=data)
        return out.sweep([n for n in self.children() if n != "data"])

    def sweep(self, names: list[str] | None = None) -> Library:
        """Without rows that hang on no book."""
        ids = self["books"].select(F.col("id").alias("_b"))
        return self.replace(**{n: self[n].join(ids, F.col("book") == F.col("_b"), "left_semi") for n in names or self.children()})


def relative_path(book_path: str, basename: str, fmt: str):
    """book path/basename.format; without a path basename.format; without a basename the path alone."""
    p, b, f = (F.trim(F.coalesce(F.col(c), F.lit(""))) for c in (book_path, basename, fmt))
    name = F.when(b == "", F.lit("")).when(f == "", b).otherwise(F.concat(b, F.lit("."), F.lower(f)))
    return F.when(p == "", name).when(name == "", p).otherwise(F.concat(p, F.lit("/"), name))
