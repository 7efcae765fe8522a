"""The rule waterfall over scanned files, manual reviews, and decisions of people."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.ids import stable_id
from shelfmark.functions.text import blank
from shelfmark.operators.dedup import duplicate_groups, first_hit, keep_by_file, not_target, title_ext_size_key
from shelfmark.rules import REASON_ORDER, RuleSet


def waterfall(files: DataFrame, garbled: Column, rules: RuleSet = RuleSet()) -> DataFrame:
    """One row per file with the first rule that takes it: ``reason_code, matched_value, recommended_action, reason_order``; null reason if none.

    Order: junk title, garbled title, duplicates (all members, the kept one too), other format, copy marker, unknown base name. Duplicates
    are looked for among what the rules before them leave. Files: ``data_id, title, ext, bytes, actual_bytes, file_basename,
    file_exists, relative_path``.
    """
    junk = first_hit("title", rules.junk_keywords)
    early = files.withColumn("_junk", junk).withColumn("_bad", F.col("_junk").isNull() & garbled)
    left = early.where(F.col("_junk").isNull() & ~F.col("_bad"))
    dup = duplicate_groups(left, title_ext_size_key(), keep_by_file("file_exists", "file_basename", "relative_path", "data_id", rules)).select(F.col("data_id").alias("_id"), "group_key", "keep").dropDuplicates(["_id"])
    r = early.join(dup, early["data_id"] == dup["_id"], "left")
    copy, unknown = first_hit("title", rules.copy_markers), first_hit("file_basename", rules.unknown_markers)
    other = not_target("ext", rules.target_formats)
    ladder = [
        (F.col("_junk").isNotNull(), "title_junk_keyword", F.col("_junk"), F.lit("delete_file")),
        (F.col("_bad"), "title_mojibake", blank("title"), F.lit("keep")),
        (F.col("group_key").isNotNull(), "duplicate_title_ext_bytes", F.col("group_key"), F.when(F.col("keep"), "keep").otherwise("delete_file")),
        (other, "non_target_format", F.upper(blank("ext")), F.lit("delete_file")),
        (copy.isNotNull(), "title_copy", copy, F.lit("keep")),
        (unknown.isNotNull(), "file_basename_unknown", unknown, F.lit("keep")),
    ]
    none = F.lit(None).cast("string")
    reason, value, action = none, none, none
    for cond, name, v, a in reversed(ladder):
        reason, value, action = F.when(cond, name).otherwise(reason), F.when(cond, v).otherwise(value), F.when(cond, a).otherwise(action)
    out = r.select(*files.columns, reason.alias("reason_code"), value.alias("matched_value"), action.alias("recommended_action"))
    return out.withColumn("reason_order", F.element_at(F.create_map(*[F.lit(x) for x in chain.from_iterable(REASON_ORDER.items())]), F.coalesce("reason_code", F.lit(""))))


def candidate_id(batch: str = "batch") -> Column:
    return stable_id(batch, F.col("book_id"), F.col("data_id"), "reason_code", "matched_value")


def resolve_action(human: str, recommended: str, valid: tuple[str, ...], default: str) -> Column:
    """The person's decision if there is one, else the recommendation; the default for what is not valid."""
    h = F.lower(F.trim(blank(human)))
    a = F.when(h != "", h).otherwise(F.trim(blank(recommended)))
    return F.when(a.isin(*valid), a).otherwise(F.lit(default))


def check_status(human: str, valid: tuple[str, ...]) -> Column:
    """manual_required without a decision, invalid_action for an unknown one, else ready."""
    h = F.trim(blank(human))
    return F.when(h == "", "manual_required").when(~h.isin(*valid), "invalid_action").otherwise("ready")


def carry_over(new: DataFrame, old: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """The new report with the people's columns of the old one where those are not blank. Of repeated old rows the greatest value counts."""
    o = old.groupBy(*keys).agg(*[F.max(F.when(F.trim(blank(c)) != "", F.col(c))).alias(f"_{c}") for c in columns])
    j = new.join(o, keys, "left")
    return j.select(*[F.coalesce(f"_{c}", c).alias(c) if c in columns else F.col(c) for c in new.columns])


def last_by_key(rows: DataFrame, key: str, seq: str) -> DataFrame:
    """Of rows with one integer key the last in sequence; rows without an integer key are dropped."""
    k = F.col(key).cast("string").try_cast("bigint")
    cols = [c for c in rows.columns if c != key]
    best = rows.withColumn("_key", k).where("_key is not null").groupBy("_key").agg(F.max_by(F.struct(*cols), seq).alias("r"))
    return best.select(F.col("_key").alias(key), "r.*")
