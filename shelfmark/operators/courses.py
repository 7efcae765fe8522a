"""Course manifests: paths to normalised tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.ids import with_surrogate
from shelfmark.functions.text import blank, replacement_damaged

#: What is taken off the end of a course title.
TITLE_ENDS = r"【完结】[-—－\s]*$|\(完\)$|（完）$|\s*[-—－]+\s*$"


def split_path(path: Column | str, depth: int = 6) -> list[Column]:
    """dir_1 .. dir_depth; null beyond the path's end."""
    parts = F.split(blank(path), r"[\\/]")
    return [F.try_element_at(parts, F.lit(i)).alias(f"dir_{i}") for i in range(1, depth + 1)]


def lecturer(title: Column | str) -> Column:
    """What stands before a middle dot, else null."""
    x = blank(title)
    return F.when(x.contains("·"), F.trim(F.substring_index(x, "·", 1)))


def clean_title(title: Column | str) -> Column:
    return F.trim(F.regexp_replace(blank(title), TITLE_ENDS, ""))


def courses(files: DataFrame) -> DataFrame:
    """One row per (source, channel, title) with its number of files and the first by ``no1``."""
    return files.groupBy("source", "channel", clean_title("title").alias("title")).agg(F.count("*").alias("n_files"), F.min_by("file", F.struct("no1", "file")).alias("first_file"))


def dimension(df: DataFrame, column: str, levels: int = 2, mark: str = "：") -> DataFrame:
    """A dimension table of a column's distinct values: ``id, value, level_1 .. level_n``; a value is split at the mark, what is left stays in the last level.

    Ids follow the values' order; blank values are none.
    """
    v = df.select(F.trim(blank(column)).alias("value")).where("value <> ''").distinct()
    parts = F.split("value", mark, levels)
    cols = [F.nullif(F.trim(F.get(parts, F.lit(i))), F.lit("")).alias(f"level_{i + 1}") for i in range(levels)]
    return with_surrogate(v.select("value", *cols), "id", ["value"]).select("id", "value", *[f"level_{i + 1}" for i in range(levels)])


def diff_courses(new: DataFrame, old: DataFrame, keys: list[str], files: str = "n_files") -> DataFrame:
    """Keys with the action that brings the old courses to the new ones: insert_course, insert_files (more files than before), keep_target or report_only (gone)."""
    one = lambda d, n: d.groupBy(*keys).agg(F.max(files).alias(n))
    j = one(new, "_new").join(one(old, "_old"), keys, "full_outer")
    return j.select(*keys, F.when(F.col("_old").isNull(), "insert_course").when(F.col("_new").isNull(), "report_only").when(F.col("_new") > F.col("_old"), "insert_files").otherwise("keep_target").alias("action"))


def rejected(path: Column | str, title: Column | str, known: tuple[str, ...] = (), depth: int = 4) -> Column:
    """Why a row of a manifest makes no course: mojibake, shallow_path, unknown_platform or empty_title; null if it does."""
    levels = F.size(F.filter(F.split(blank(path), r"[\\/]"), lambda x: x != ""))
    first = F.get(F.filter(F.split(blank(path), r"[\\/]"), lambda x: x != ""), F.lit(0))
    why = F.when(replacement_damaged(path) | replacement_damaged(title), "mojibake").when(levels < depth, "shallow_path")
    if known:
        why = why.when(~first.isin(*known), "unknown_platform")
    return why.when(clean_title(title) == "", "empty_title")


def inverted_index(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """``term, key, n``: how often each word stands in a row's columns."""
    text = F.lower(F.concat_ws(" ", *columns))
    words = F.explode(F.filter(F.split(text, r"[^\p{L}\p{N}]+"), lambda w: w != ""))
    return df.select(key, words.alias("term")).groupBy("term", key).agg(F.count("*").alias("n"))
