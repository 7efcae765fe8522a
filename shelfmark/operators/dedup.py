"""Keyed deduplication, junk and format filters, and the first cleaning step composed of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.text import blank, normalize_title
from shelfmark.rules import RuleSet


def title_bytes_path_key(title: str = "title", size: str = "bytes", path: str = "init_path") -> list[Column]:
    return [normalize_title(title).alias("k1"), F.coalesce(F.col(size), F.lit(0)).cast("bigint").alias("k2"), blank(path).alias("k3")]


def title_ext_size_key(title: str = "title", ext: str = "ext", size: str = "bytes", actual: str = "actual_bytes") -> list[Column]:
    """Size as recorded, else as found; null if neither is known."""
    return [normalize_title(title).alias("k1"), F.lower(blank(ext)).alias("k2"), F.coalesce(size, actual).cast("bigint").alias("k3")]


def duplicate_groups(df: DataFrame, keys: list[Column], order: list[Column]) -> DataFrame:
    """The rows of groups of at least two, with ``group_key`` (the key's parts joined by |), ``group_size`` and ``keep``.

    keep marks the least row by the order; the order's columns must tell the rows of a group apart, else equal least rows are all kept.
    A key with a null part is no key. Groups are found by an aggregation with partial results and joined back, so that a
    group of any size is spread over tasks. An empty table gives an empty result; all columns are kept.
    """
    names = [f"_k{i}" for i in range(len(keys))]
    keyed = df.select("*", *[k.alias(n) for k, n in zip(keys, names)], F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)]).alias("_o"))
    for n in names:
        keyed = keyed.where(F.col(n).isNotNull())
    best = keyed.groupBy(*names).agg(F.min("_o").alias("_best"), F.count("*").alias("group_size")).where("group_size > 1")
    return keyed.join(best, names).withColumn("group_key", F.concat_ws("|", *names)).withColumn("keep", F.col("_o") == F.col("_best")).drop("_o", "_best", *names)


def with_action(groups: DataFrame) -> DataFrame:
    return groups.withColumn("recommended_action", F.when(F.col("keep"), F.lit("keep")).otherwise("delete_file"))


def keep_by_file(exists: str, basename: str, path: str, id_: str, rules: RuleSet = RuleSet()) -> list[Column]:
    """Order of survivors: an existing file, a known base name, the shorter path, the least id."""
    return [F.when(F.col(exists), 0).otherwise(1), F.when(first_hit(basename, rules.unknown_markers).isNotNull(), 1).otherwise(0), F.length(blank(path)), F.col(id_)]


def first_hit(c: Column | str, words: tuple[str, ...]) -> Column:
    """The first word, in the list's order, that the text contains; else null."""
    x = blank(c)
    out = F.lit(None).cast("string")
    for w in reversed(words):
        out = F.when(x.contains(w), F.lit(w)).otherwise(out)
    return out


def not_target(ext: Column | str, formats: tuple[str, ...]) -> Column:
    return ~F.lower(F.trim(blank(ext))).isin(*formats)


def clean(records: DataFrame, rules: RuleSet = RuleSet()) -> DataFrame:
    """The first cleaning step as one row per record: ``reason_code, matched_value, recommended_action`` beside the record.

    Records (``book_id, data_id, title, bytes, init_path, ext``) that repeat a kept one are deleted; of the rest those with a junk title; of the rest
    those of no target format. Null reason: kept as it is. A group's kept record is reported with its group unless a later
    rule takes it.
    """
    groups = duplicate_groups(records, title_bytes_path_key(), [F.col("data_id")]).select(F.col("data_id").alias("_id"), "group_key", "keep").dropDuplicates(["_id"])
    r = records.join(groups, records["data_id"] == groups["_id"], "left")
    junk, other = first_hit("title", rules.junk_keywords), not_target("ext", rules.target_formats)
    gone = F.coalesce(~F.col("keep"), F.lit(False))
    reason = F.when(gone, "duplicate_title_bytes_initpath").when(junk.isNotNull(), "title_junk_keyword").when(other, "non_target_format").when(F.col("keep"), "duplicate_title_bytes_initpath")
    value = F.when(gone, F.col("group_key")).when(junk.isNotNull(), junk).when(other, F.upper("ext")).when(F.col("keep"), F.col("group_key"))
    action = F.when(gone | junk.isNotNull() | other, "delete_file").otherwise("keep")
    return r.select(*records.columns, reason.alias("reason_code"), value.alias("matched_value"), action.alias("recommended_action"))


def deleted_books(flags: DataFrame, legacy: bool = False) -> DataFrame:
    """``book_id`` of books to delete: those all of whose files go. legacy: those with a file to delete and no kept group member."""
    if legacy:
        kept = flags.where("reason_code = 'duplicate_title_bytes_initpath' and recommended_action = 'keep'").select("book_id")
        return flags.where("recommended_action = 'delete_file'").select("book_id").distinct().join(kept, "book_id", "left_anti")
    return flags.groupBy("book_id").agg(F.count_if(F.col("recommended_action") != "delete_file").alias("n")).where("n = 0").select("book_id")
