"""Merging books that are one: blocking, the winner of a block, claims on formats, and applying the plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.ids import with_surrogate
from shelfmark.functions.session import cut
from shelfmark.functions.text import blank, normalize_title
from shelfmark.rules import UNKNOWN_PREFIX
from shelfmark.sources.library import Library


def path_prefix(path: Column | str = "path", book: Column | str = "id") -> Column:
    """The path without its ending ' (id)'; null without that ending."""
    p, b = (F.col(c) if isinstance(c, str) else c for c in (path, book))
    end = F.concat(F.lit(" ("), b.cast("string"), F.lit(")"))
    return F.when(F.endswith(p, end), F.substring(p, F.lit(1), F.length(p) - F.length(end)))


def title_author(title: str = "title", author: str = "author_sort") -> Column:
    """Block by normalised title and author; null for a blank title."""
    t = normalize_title(title)
    return F.when(t != "", F.concat(t, F.lit("|"), F.lower(F.trim(blank(author)))))


def plan(books: DataFrame, data: DataFrame, block: Column) -> DataFrame:
    """One row per file of a losing book: ``block, winner_id, loser_id, data_id, format, moved``.

    Of a block with at least two books the one with most files wins, then the least id. A loser's file moves if its format is
    not blank, the winner lacks it, and no file with a lesser (loser, id) claims it; else it is a duplicate. A losing book without files has
    one row with null data_id. Books with a null block stay alone. All by aggregation: a block may be of any size.
    """
    b = books.select(F.col("id").alias("book_id"), block.alias("block")).where("block is not null")
    d = data.where("book is not null").select(F.col("id").alias("data_id"), F.col("book").alias("book_id"), F.upper(F.trim(blank("format"))).alias("format"))
    n = d.groupBy("book_id").agg(F.count("*").alias("n"))
    sized = b.join(n, "book_id", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    win = sized.groupBy("block").agg(F.min(F.struct((-F.col("n")).alias("a"), F.col("book_id")))["book_id"].alias("winner_id"), F.count("*").alias("books")).where("books > 1").drop("books")
    losers = b.join(win, "block").where("book_id <> winner_id").withColumnRenamed("book_id", "loser_id")
    files = losers.join(d.withColumnRenamed("book_id", "loser_id"), "loser_id", "left")
    has = win.join(d.withColumnRenamed("book_id", "winner_id"), "winner_id").select("block", "format", F.lit(True).alias("_has")).distinct()
    claim = files.where("format <> ''").groupBy("block", "format").agg(F.min(F.struct("loser_id", "data_id")).alias("_first"))
    j = files.join(has, ["block", "format"], "left").join(claim, ["block", "format"], "left")
    moved = F.col("data_id").isNotNull() & (F.col("format") != "") & F.col("_has").isNull() & (F.struct("loser_id", "data_id") == F.col("_first"))
    return j.select("block", "winner_id", "loser_id", "data_id", "format", F.coalesce(moved, F.lit(False)).alias("moved"))


def numbered(plan_rows: DataFrame, prefix: str = "G") -> DataFrame:
    """Adds ``merge_group``: the prefix and the block's number of at least four digits, in the order of the blocks."""
    blocks = with_surrogate(plan_rows.select("block").distinct(), "_n", ["block"])
    return plan_rows.join(blocks, "block").withColumn("merge_group", F.concat(F.lit(prefix), F.when(F.col("_n") < 10000, F.lpad(F.col("_n").cast("string"), 4, "0")).otherwise(F.col("_n").cast("string")))).drop("_n")


def report(numbered_rows: DataFrame) -> DataFrame:
    """One row per losing book with its formats and file ids packed as text."""
    listed = lambda c: F.concat_ws(",", F.transform(F.array_sort(F.collect_list(F.when(c, F.col("data_id")))), lambda x: x.cast("string")))
    return numbered_rows.groupBy("merge_group", "block", "winner_id", "loser_id").agg(F.concat_ws(",", F.array_sort(F.collect_set("format"))).alias("loser_formats"), listed(F.col("moved")).alias("moved_data_ids"), listed(~F.col("moved")).alias("duplicate_data_ids"))


def apply(lib: Library, plan_rows: DataFrame) -> Library:
    """Moved files go to the winner, duplicates and losing books with all that hangs on them go."""
    p = plan_rows.where("data_id is not null").select(F.col("data_id").alias("_id"), F.col("winner_id").alias("_win"), F.col("moved").alias("_moved"))
    d = lib["data"]
    moved = d.join(p, d["id"] == p["_id"], "left").where("_id is null or _moved")
    data = moved.select(*[F.coalesce("_win", "book").alias("book") if c == "book" else F.col(c) for c in d.columns])
    losers = plan_rows.select(F.col("loser_id").alias("_loser")).distinct()
    out = lib.replace(books=lib["books"].join(losers, F.col("id") == F.col("_loser"), "left_anti"), data=data)
    for n in lib.children():
        if n != "data":
            out = out.replace(**{n: lib[n].join(losers, F.col("book") == F.col("_loser"), "left_anti")})
    return out


def unknown_origin(prefix: Column | None = None) -> Column:
    """The block of books whose path says that their origin is unknown; null for all others. Such blocks are for people."""
    p = path_prefix() if prefix is None else prefix
    return F.when(F.startswith(p, F.lit(UNKNOWN_PREFIX)), p)


def review_groups(books: DataFrame, data: DataFrame, prefix: Column | None = None) -> DataFrame:
    """The plan for books of unknown origin, as groups numbered U0001 on; nothing of it is applied."""
    return numbered(plan(books, data, unknown_origin(prefix)), "U")


def merge(lib: Library) -> tuple[Library, DataFrame, DataFrame]:
    """By path prefix, then by title and author on the result: the library and both plans. Blocks of unknown origin are left for people."""
    known = F.when(~F.startswith(path_prefix(), F.lit(UNKNOWN_PREFIX)), path_prefix())
    first = cut(plan(lib["books"], lib["data"], known))
    half = apply(lib, first)
    second = cut(plan(half["books"], half["data"], title_author()))
    return apply(half, second), first, second


def merge_deletions(before: DataFrame, after: DataFrame, plan_rows: DataFrame) -> DataFrame:
    """``data_id, action``: files that are gone are deleted, other files of losing books are put aside."""
    gone = before.select(F.col("id").alias("data_id")).join(after.select(F.col("id").alias("data_id")), "data_id", "left_anti")
    aside = plan_rows.where("data_id is not null").select("data_id").distinct().join(gone, "data_id", "left_anti")
    return gone.select("data_id", F.lit("delete_file").alias("action")).unionByName(aside.select("data_id", F.lit("quarantine_file").alias("action")))
