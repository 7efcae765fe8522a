"""Queries p4 and p7 over the test tables, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfmark.functions.session import table
from shelfmark.operators.reconcile import differences
from shelfmark.operators.references import orphans


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return differences(table(spark, d, "scan_compare")).select("sync_id", "difference")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    parents = {"book_id": (table(spark, d, "books"), "id", "added_at", "deleted_at"), "data_id": (table(spark, d, "data_rows"), "id", "added_at", "deleted_at")}
    return orphans(table(spark, d, "book_files"), parents, "batch", "seen_at").withColumnRenamed("period", "batch").select("ref_field", "ref_id", "batch")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p4_found, p7_found)}


_SET = "array_to_string(list_sort(list_distinct(list_filter(list_transform(string_split(coalesce({0}, ''), ';'), lambda x: trim(x)), lambda x: x <> ''))), ';')"

P4 = f"""
WITH r AS (
  SELECT sync_id, compare_side, {_SET.format("authors")} AS a, {_SET.format("tags")} AS t, {_SET.format("identifiers")} AS i, trim(coalesce(publisher, '')) AS p
  FROM scan_compare QUALIFY row_number() OVER (PARTITION BY sync_id, compare_side ORDER BY scanned_at DESC) = 1
), j AS (
  SELECT coalesce(x.sync_id, y.sync_id) AS sync_id, x.sync_id AS xs, y.sync_id AS ys, x.a AS xa, y.a AS ya, x.t AS xt, y.t AS yt, x.i AS xi, y.i AS yi, x.p AS xp, y.p AS yp
  FROM (SELECT * FROM r WHERE compare_side = 'incremental') x FULL JOIN (SELECT * FROM r WHERE compare_side = 'full') y ON x.sync_id = y.sync_id
)
SELECT sync_id, 'full_missing' AS difference FROM j WHERE ys IS NULL UNION ALL SELECT sync_id, 'incremental_missing' FROM j WHERE xs IS NULL
UNION ALL SELECT sync_id, 'authors' FROM j WHERE xa <> ya UNION ALL SELECT sync_id, 'tags' FROM j WHERE xt <> yt
UNION ALL SELECT sync_id, 'identifiers' FROM j WHERE xi <> yi UNION ALL SELECT sync_id, 'publisher' FROM j WHERE xp <> yp
"""

P7 = """
WITH r AS (
  SELECT DISTINCT 'book_id' AS ref_field, book_id AS ref_id, batch, seen_at FROM book_files WHERE book_id IS NOT NULL AND seen_at IS NOT NULL
  UNION ALL SELECT DISTINCT 'data_id', data_id, batch, seen_at FROM book_files WHERE data_id IS NOT NULL AND seen_at IS NOT NULL
), p AS (
  SELECT 'book_id' AS f, id, added_at, deleted_at FROM books UNION ALL SELECT 'data_id', id, added_at, deleted_at FROM data_rows
)
SELECT DISTINCT ref_field, ref_id, batch FROM r
WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.f = r.ref_field AND p.id = r.ref_id AND p.added_at <= r.seen_at AND (p.deleted_at IS NULL OR p.deleted_at > r.seen_at))
"""


def oracle_sql() -> dict[str, str]:
    return {"p4_found": P4, "p7_found": P7}
