"""Column-wise scan of a library for garbled text, and repair candidates from source paths."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.codec import restore_text
from shelfmark.functions.text import path_stem, replacement_damaged
from shelfmark.operators.dedup import first_hit
from shelfmark.rules import RuleSet
from shelfmark.schemas import LINKS
from shelfmark.sources.library import Library, identifier

#: The scanned columns, in the order of the report.
TARGETS = (
    ("books", "title"), ("books", "sort"), ("books", "author_sort"), ("authors", "name"), ("authors", "sort"), ("series", "name"),
    ("series", "sort"), ("publishers", "name"), ("publishers", "sort"), ("tags", "name"), ("data", "name"), ("books", "path"),
)


def unpivot(lib: Library, targets: tuple[tuple[str, str], ...] = TARGETS) -> DataFrame:
    """``target, table, column, row_id, value`` of all named columns that exist; null and empty values are left out."""
    out = None
    for i, (t, c) in enumerate(targets):
        identifier(t), identifier(c)
        if t in lib and c in lib[t].columns:
            one = lib[t].select(F.lit(i).alias("target"), F.lit(t).alias("table"), F.lit(c).alias("column"), F.col("id").cast("bigint").alias("row_id"), F.col(c).cast("string").alias("value")).where(F.col(c).isNotNull() & (F.col(c) != ""))
            out = one if out is None else out.unionByName(one)
    if out is None:
        raise ValueError("none of the columns exists")
    return out


def books_of(lib: Library) -> DataFrame:
    """``table, row_id, book_id``: all books a row belongs to, by the named link column. Rows without a book have none."""
    out = lib["books"].select(F.lit("books").alias("table"), F.col("id").alias("row_id"), F.col("id").alias("book_id"))
    if "data" in lib:
        out = out.unionByName(lib["data"].select(F.lit("data").alias("table"), F.col("id").alias("row_id"), F.col("book").alias("book_id")))
    for name, (_, link, column, _) in LINKS.items():
        if link in lib:
            out = out.unionByName(lib[link].select(F.lit(name).alias("table"), F.col(column).alias("row_id"), F.col("book").alias("book_id")))
    return out.distinct()


def scan(lib: Library, targets: tuple[tuple[str, str], ...] = TARGETS) -> DataFrame:
    """Garbled values: ``target, table, column, row_id, value, reason, restored, chain``; reason is encoding_mojibake or bytes_lost.

    A file name is not reported where its book's path can be restored, as it is the same damage.
    """
    values = unpivot(lib, targets).withColumn("r", restore_text("value"))
    hits = values.select("target", "table", "column", "row_id", "value", F.when(F.col("r.restored").isNotNull(), "encoding_mojibake").when(replacement_damaged("value"), "bytes_lost").alias("reason"), F.col("r.restored").alias("restored"), F.col("r.chain").alias("chain")).where("reason is not null")
    if "data" not in lib:
        return hits
    paths = hits.where("table = 'books' and column = 'path' and reason = 'encoding_mojibake'").select(F.col("row_id").alias("_book"))
    named = lib["data"].join(paths, F.col("book") == F.col("_book"), "left_semi").select(F.col("id").alias("_data"))
    return hits.join(named, (F.col("table") == "data") & (F.col("row_id") == F.col("_data")), "left_anti")


def handoffs(rows: DataFrame, paths: DataFrame, marker: str, book: str, markers: tuple[str, ...], still: bool) -> DataFrame:
    """Rows whose text has a marker, with a candidate from the book's only source path: ``candidate, status, reason_code``.

    paths: ``book, path`` of all distinct non-blank source paths. Reasons: missing, ambiguous (several), invalid, and with ``still`` a
    candidate that has a marker itself. With a candidate the status is update_file, else manual_confirming.
    """
    p = paths.groupBy("book").agg(F.count_distinct("path").alias("_n"), F.min("path").alias("_p"))
    r = rows.where(first_hit(marker, markers).isNotNull())
    j = r.join(p, r[book] == p["book"], "left").drop(p["book"])
    stem = path_stem("_p")
    reason = F.when(F.coalesce("_n", F.lit(0)) == 0, "missing_book_init_path").when(F.col("_n") > 1, "ambiguous_book_init_path").when(stem.isNull(), "invalid_book_init_path")
    if still:
        reason = reason.when(first_hit(stem, markers).isNotNull(), "filename_still_has_marker")
    out = j.withColumn("reason_code", F.coalesce(reason, F.lit("")))
    return out.withColumn("candidate", F.when(F.col("reason_code") == "", stem).otherwise("")).withColumn("status", F.when(F.col("candidate") != "", "update_file").otherwise("manual_confirming")).drop("_n", "_p")


def title_handoffs(books: DataFrame, paths: DataFrame, rules: RuleSet = RuleSet()) -> DataFrame:
    return handoffs(books, paths, "title", "id", rules.copy_markers, still=True)


def basename_handoffs(data: DataFrame, paths: DataFrame, rules: RuleSet = RuleSet()) -> DataFrame:
    return handoffs(data, paths, "name", "book", rules.unknown_markers, still=False)


def ids_by_book(data: DataFrame) -> DataFrame:
    """``book, data_ids``: a book's file ids in order, joined by ', '."""
    return data.where("book is not null").groupBy("book").agg(F.array_join(F.array_sort(F.collect_list("id")), ", ").alias("data_ids"))
