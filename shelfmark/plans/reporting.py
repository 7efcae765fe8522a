"""Queries of reports, statuses, loaders and plans for people."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions import codec, text
from shelfmark.functions.session import table
from shelfmark.operators import anomaly, apply, checks, classify, courses, dedup, merge, reports, upsert
from shelfmark.plans import cleaning, linking
from shelfmark.plans import sqltext as q
from shelfmark.plans.cleaning import WORDS, library
from shelfmark.rules import CLEAN_ACTIONS, NOOP_ACTIONS, REASON_DETAILS, TARGET_FORMATS, UNKNOWN_MARKERS
from shelfmark.sources.library import Library

Q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        Q[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _paths(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "book_files").select(F.col("book_id").alias("book"), F.trim("custom_column_1_value").alias("path")).where("book is not null and path <> ''").distinct()


def _titles(spark: SparkSession, d: str) -> DataFrame:
    return anomaly.title_handoffs(table(spark, d, "books").select("id", "title"), _paths(spark, d), WORDS)


def _basenames(spark: SparkSession, d: str) -> DataFrame:
    return anomaly.basename_handoffs(table(spark, d, "data_rows").select("id", "book", "name", "format"), _paths(spark, d), WORDS)


_BASE = "regexp_extract(coalesce(p, ''), '([^/' || chr(92) || chr(92) || ']*)$', 1)"
_STEM = f"trim(regexp_extract(trim({_BASE}), '^(.+)[.][^.]+$', 1))"
_BY_BOOK = "p AS (SELECT book_id AS book, count(DISTINCT trim(custom_column_1_value)) AS n, min(trim(custom_column_1_value)) AS p FROM book_files WHERE book_id IS NOT NULL AND trim(coalesce(custom_column_1_value, '')) <> '' GROUP BY 1)"
_COPY = " OR ".join(f"contains(coalesce({{0}}, ''), '{m}')" for m in WORDS.copy_markers)
_WHY = f"CASE WHEN coalesce(n, 0) = 0 THEN 'missing_book_init_path' WHEN n > 1 THEN 'ambiguous_book_init_path' WHEN {_STEM} = '' THEN 'invalid_book_init_path'"
_HANDOFFS = f"""{_BY_BOOK},
    th AS (SELECT id, title, {_WHY} WHEN {_COPY.format(_STEM)} THEN 'filename_still_has_marker' ELSE '' END AS why, {_STEM} AS stem FROM books b LEFT JOIN p ON b.id = p.book WHERE {_COPY.format("title")}),
    bh AS (SELECT id, d.book, name, format, {_WHY} ELSE '' END AS why, {_STEM} AS stem FROM data_rows d LEFT JOIN p ON d.book = p.book WHERE {q.first_hit("name", UNKNOWN_MARKERS)} IS NOT NULL)"""
_STATUS = "CASE WHEN {0} IS NULL THEN 'not_reported' WHEN {0} = '' THEN 'update_file' ELSE 'manual_confirming' END"
_REVIEW_ID = "substr(sha1(coalesce(batch, '') || '|' || coalesce(book_id::VARCHAR, '') || '|' || coalesce(data_id::VARCHAR, '') || '|' || reason_code || '|' || matched_value), 1, 16)"
_HITS = f"""h AS (SELECT *, 'title_mojibake' AS reason_code, coalesce(title, '') AS matched_value FROM book_files WHERE contains(coalesce(title, ''), chr(65533)) UNION ALL SELECT *, 'title_copy', title FROM book_files WHERE {_COPY.format("title")}
      UNION ALL SELECT *, 'file_basename_unknown', {q.first_hit("file_basename", UNKNOWN_MARKERS)} FROM book_files WHERE {q.first_hit("file_basename", UNKNOWN_MARKERS)} IS NOT NULL)"""


@query(
    f"""WITH {_HANDOFFS}, {_HITS}, v AS (SELECT DISTINCT {_REVIEW_ID} AS review_id, book_id, data_id, reason_code, matched_value FROM h)
    SELECT review_id, v.book_id, v.data_id, reason_code, CASE reason_code {" ".join(f"WHEN '{k}' THEN '{x}'" for k, x in REASON_DETAILS.items())} END AS reason_detail, matched_value, 'keep' AS recommended_action,
    CASE WHEN reason_code = 'title_copy' THEN {_STATUS.format("th.why")} ELSE '' END AS step2_repair_title_repair_status, CASE WHEN reason_code = 'title_copy' THEN coalesce(th.why, '') ELSE '' END AS step2_repair_title_repair_reason,
    CASE WHEN reason_code = 'title_copy' AND th.why = '' THEN th.stem ELSE '' END AS step2_repair_title_candidate, CASE WHEN reason_code = 'file_basename_unknown' THEN {_STATUS.format("bh.why")} ELSE '' END AS step2_repair_basename_repair_status,
    CASE WHEN reason_code = 'file_basename_unknown' AND bh.why = '' THEN bh.stem ELSE '' END AS step2_repair_basename_candidate
    FROM v LEFT JOIN th ON v.book_id = th.id LEFT JOIN bh ON v.data_id = bh.id"""
)
def manual_review_rows(spark: SparkSession, d: str) -> DataFrame:
    none = F.lit("")
    titles = _titles(spark, d).select(F.col("id").alias("book_id"), "status", "reason_code", none.alias("reason_detail"), "candidate")
    names = _basenames(spark, d).select(F.col("id").alias("data_id"), "status", "reason_code", none.alias("reason_detail"), "candidate")
    r = reports.manual_reviews(table(spark, d, "book_files"), codec.is_mojibake("title"), titles, names, rules=WORDS)
    return r.select("review_id", "book_id", "data_id", "reason_code", "reason_detail", "matched_value", "recommended_action", *[f"step2_repair_title_{c}" for c in ("repair_status", "repair_reason", "candidate")], *[f"step2_repair_basename_{c}" for c in ("repair_status", "candidate")])


def _set_message(a: str, b: str) -> str:
    only = lambda x, y: f"array_to_string(list_filter({x}, lambda x: NOT list_contains({y}, x)), ', ')"
    x, y = only(a, b), only(b, a)
    return f"CASE WHEN len({a}) = 0 AND len({b}) = 0 THEN 'same(empty)' WHEN {x} = '' AND {y} = '' THEN 'same: ' || array_to_string({a}, ', ') ELSE 'delta: ' || concat_ws('; ', CASE WHEN {x} <> '' THEN 'source_only=' || {x} END, CASE WHEN {y} <> '' THEN 'target_only=' || {y} END) END"


def _value_message(a: str, b: str) -> str:
    return f"CASE WHEN {a} = '' AND {b} = '' THEN 'same(empty)' WHEN {b} = '' THEN 'target_missing: ' || {a} WHEN {a} = '' THEN 'source_missing: ' || {b} WHEN {a} = {b} THEN 'same: ' || {a} ELSE 'conflict: source=' || {a} || '; target=' || {b} END"


_SIDES = f"""r AS (SELECT sync_id, compare_side, {linking._LIST.format("authors")} AS au, {linking._LIST.format("tags")} AS tg, {linking._LIST.format("languages")} AS la, CASE WHEN rating IS NULL THEN [] ELSE [rating::VARCHAR] END AS ra,
      trim(coalesce(publisher, '')) AS pu, trim(coalesce(series, '')) AS se FROM ({linking._LAST})),
    p AS (SELECT coalesce(x.sync_id, y.sync_id) AS sync_id, coalesce(x.au, []) AS au1, coalesce(y.au, []) AS au2, coalesce(x.tg, []) AS tg1, coalesce(y.tg, []) AS tg2, coalesce(x.la, []) AS la1, coalesce(y.la, []) AS la2, coalesce(x.ra, []) AS ra1, coalesce(y.ra, []) AS ra2,
      coalesce(x.pu, '') AS pu1, coalesce(y.pu, '') AS pu2, coalesce(x.se, '') AS se1, coalesce(y.se, '') AS se2 FROM (SELECT * FROM r WHERE compare_side = 'incremental') x FULL JOIN (SELECT * FROM r WHERE compare_side = 'full') y ON x.sync_id = y.sync_id)"""
_MAPS = f"""{linking._IDS}, f AS (SELECT coalesce(x.sync_id, y.sync_id) AS sync_id, coalesce(x.k, y.k) AS k, x.v AS a, y.v AS b FROM (SELECT * FROM i WHERE compare_side = 'incremental') x FULL JOIN (SELECT * FROM i WHERE compare_side = 'full') y ON x.sync_id = y.sync_id AND x.k = y.k),
    m AS (SELECT sync_id, max(CASE WHEN b IS NULL THEN 2 WHEN a IS NULL THEN 1 WHEN a <> b THEN 3 ELSE 0 END) AS s, bool_or(b IS NULL) AS lacks,
      string_agg(CASE WHEN a IS NULL THEN k || ':source_missing(target=' || b || ')' WHEN b IS NULL THEN k || ':target_missing(source=' || a || ')' WHEN a = b THEN k || ':same(' || a || ')' ELSE k || ':conflict(source=' || a || ',target=' || b || ')' END, '; ' ORDER BY k) AS t FROM f GROUP BY 1)"""


@query(
    f"""WITH {_SIDES}, {_MAPS}, w AS (SELECT p.*, m.t, coalesce(m.s, 0) AS ms, greatest({linking._worst("au1/au2 tg1/tg2 la1/la2 ra1/ra2", "pu1/pu2 se1/se2")}, coalesce(m.s, 0)) AS s FROM p LEFT JOIN m ON p.sync_id = m.sync_id)
    SELECT sync_id, {_set_message("au1", "au2")} AS authors_compare, {_set_message("tg1", "tg2")} AS tags_compare, {_value_message("pu1", "pu2")} AS publisher_compare, {_set_message("la1", "la2")} AS languages_compare, {_set_message("ra1", "ra2")} AS rating_compare,
    {_value_message("se1", "se2")} AS series_compare, CASE WHEN t IS NULL THEN 'same(empty)' WHEN ms = 0 THEN 'same: ' || t ELSE 'delta: ' || t END AS identifiers_compare, CASE s WHEN 3 THEN 'conflict' WHEN 2 THEN 'target_missing' WHEN 1 THEN 'target_extra' ELSE 'same' END AS metadata_compare FROM w"""
)
def scan_report(spark: SparkSession, d: str) -> DataFrame:
    """Both sides of every sync_id, one-sided ones too, facet by facet."""
    last = linking._latest(spark, d)
    none = F.array().cast("array<string>")

    def side(name: str, p: str) -> DataFrame:
        facets = {f: linking._split(F.col(f"r.{f}")) for f in ("authors", "tags", "languages")} | {"rating": F.filter(F.array(F.col("r.rating").cast("string")), lambda x: x.isNotNull())}
        facets |= {f: F.col(f"r.{f}") for f in ("publisher", "series")} | {"identifiers": linking._by_type(F.col("r.identifiers"))}
        return last.where(F.col("compare_side") == name).select("sync_id", *[c.alias(f"{p}_{f}") for f, c in facets.items()])

    j = side("incremental", "a").join(side("full", "b"), "sync_id", "full_outer")
    of = lambda p: {f: F.coalesce(F.col(f"{p}_{f}"), none) if f in ("authors", "tags", "languages", "rating") else F.col(f"{p}_{f}") for f in reports.FACETS if f != "comments"}
    return j.select("sync_id", *[c for c in reports.compare_facets(of("a"), of("b"))]).drop("delta")


@query(
    f"""WITH {linking._IDS}, c AS (SELECT sync_id, compare_side, lower(k) AS k, min(v) AS v FROM i GROUP BY 1, 2, 3),
    j AS (SELECT coalesce(s.sync_id, t.sync_id) AS b, coalesce(s.k, t.k) AS k, s.v AS sv, t.v AS tv, CASE WHEN t.k IS NULL THEN 'source_only' WHEN s.k IS NULL THEN 'target_only' WHEN s.v = t.v THEN 'same' ELSE 'conflict' END AS st
      FROM (SELECT * FROM c WHERE compare_side = 'incremental') s FULL JOIN (SELECT * FROM c WHERE compare_side = 'full') t ON s.sync_id = t.sync_id AND s.k = t.k),
    x AS (SELECT *, 'incremental' AS side, sv AS v FROM j WHERE st <> 'target_only' UNION ALL SELECT *, 'full', tv FROM j WHERE st <> 'source_only')
    SELECT '' AS sync_id, side AS compare_side, 'identifiers' AS metadata_scope, k AS metadata_key, b || ':' || b || ':identifiers:' || k AS pair_key, st AS compare_status, v AS field_value,
    CASE st WHEN 'source_only' THEN 'insert' WHEN 'conflict' THEN 'merge_metadata' ELSE 'keep_target' END AS recommended_action, 'identifiers:book=' || b || ':' || st AS detail FROM x"""
)
def child_report(spark: SparkSession, d: str) -> DataFrame:
    return reports.child_rows(linking.child_diff(spark, d), "identifiers")


@query(
    f"""WITH {_HANDOFFS}, i AS (SELECT book, string_agg(id, ', ' ORDER BY id) AS ids FROM data_rows GROUP BY 1)
    SELECT id AS book_id, coalesce(ids, '') AS data_ids, title AS original_title, CASE WHEN why = '' THEN stem ELSE '' END AS title_candidate, CASE WHEN why = '' THEN 'update_file' ELSE 'manual_confirming' END AS status, why AS reason_code FROM th LEFT JOIN i ON th.id = i.book"""
)
def title_report(spark: SparkSession, d: str) -> DataFrame:
    return reports.title_report(_titles(spark, d), anomaly.ids_by_book(table(spark, d, "data_rows")))


@query(f"WITH {_HANDOFFS} SELECT book AS book_id, id AS data_id, name AS original_file_basename, format, CASE WHEN why = '' THEN stem ELSE '' END AS file_basename_candidate, CASE WHEN why = '' THEN 'update_file' ELSE 'manual_confirming' END AS status, why AS reason_code FROM bh")
def basename_report(spark: SparkSession, d: str) -> DataFrame:
    return reports.basename_report(_basenames(spark, d))


@query(f"WITH {_HANDOFFS} SELECT 'title' AS what, count(*) FILTER (why = '') AS n_auto, count(*) FILTER (why <> '') AS n_manual FROM th UNION ALL SELECT 'file_basename', count(*) FILTER (why = ''), count(*) FILTER (why <> '') FROM bh")
def repair_preview(spark: SparkSession, d: str) -> DataFrame:
    return apply.preview(_titles(spark, d), _basenames(spark, d))


_FORMATS = cleaning._FORMATS
_OTHER = f"lower(trim(coalesce(format, ''))) NOT IN ({_FORMATS})"


@query(f"SELECT id, book, 'formats' AS source, 0 AS source_order, upper(trim(format)) AS matched_value FROM data_rows WHERE {_OTHER} UNION ALL SELECT d.id, d.book, 'deleted', 1, NULL FROM data_rows d WHERE deleted_at IS NOT NULL")
def stacked_plans(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "data_rows")
    formats = rows.where(dedup.not_target("format", TARGET_FORMATS)).select("id", "book", F.upper(F.trim("format")).alias("matched_value"))
    return reports.stacked({"formats": formats, "deleted": rows.where("deleted_at is not null").select("id", "book")}).select("id", "book", "source", "source_order", "matched_value")


_NOOP = ", ".join(f"'{a}'" for a in NOOP_ACTIONS)


@query(
    f"""WITH h AS (SELECT review_id, trim(coalesce(human_decision, '')) AS h, trim(coalesce(recommended_action, '')) AS r FROM manual_reviews), a AS (SELECT *, CASE WHEN h <> '' THEN lower(h) ELSE r END AS action FROM h)
    SELECT review_id AS sync_id, action, CASE WHEN h = '' THEN 'manual_required' WHEN action IN ({_NOOP}) THEN 'skipped' ELSE 'success' END AS execute_status, CASE WHEN h = '' THEN 'not_verified' WHEN action IN ({_NOOP}) THEN 'not_applicable' ELSE 'verified' END AS verification_status FROM a"""
)
def merge_statuses(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "manual_reviews").select(F.col("review_id").alias("sync_id"), "recommended_action", "human_decision", F.lit(True).alias("manual"))
    return reports.merge_statuses(rows).select("sync_id", "action", "execute_status", "verification_status")


@query(
    f"""WITH s AS ({linking.SQL["upsert_files"]}), b AS (SELECT data_id, arg_min(book_id, struct_pack(a := seen_at)) AS book FROM book_files WHERE data_id IS NOT NULL AND book_id IS NOT NULL GROUP BY 1)
    SELECT data_id AS source_book, CASE WHEN count(*) FILTER (status = 'conflict') > 0 THEN 'conflict' WHEN count(*) FILTER (status = 'inserted') > 0 THEN 'updated' ELSE 'already_synced' END AS metadata_status,
    count(*) FILTER (status = 'inserted') AS n_changed, count(*) FILTER (status = 'conflict') AS n_conflicts FROM (SELECT source_id AS data_id, status FROM s) GROUP BY 1"""
)
def sync_rollup(spark: SparkSession, d: str) -> DataFrame:
    """The statuses of an upsert rolled up; each file stands for a source of its own."""
    return reports.metadata_status(linking.upsert_files(spark, d).select(F.col("source_id").alias("source_book"), "status"))


@query(
    """WITH l AS (SELECT relative_path AS p, max(actual_bytes) AS n FROM book_files WHERE file_exists GROUP BY 1), f AS (SELECT d.id AS data_id, b.id AS book_id, d.uncompressed_size AS bytes, lower(trim(coalesce(d.format, ''))) AS ext,
      trim(b.path) || '/' || trim(d.name) || '.' || lower(trim(d.format)) AS relative_path FROM books b JOIN data_rows d ON d.book = b.id)
    SELECT data_id, book_id, ext, bytes, f.relative_path, l.p IS NOT NULL AS file_exists, l.n AS actual_bytes FROM f LEFT JOIN l ON f.relative_path = l.p"""
)
def found_files(spark: SparkSession, d: str) -> DataFrame:
    disk = table(spark, d, "book_files").where("file_exists").select("relative_path", "actual_bytes")
    return library(spark, d).found_files(disk).select("data_id", "book_id", "ext", "bytes", "relative_path", "file_exists", "actual_bytes")


@query("SELECT book, count(*) AS n_files FROM data_rows WHERE book IN (SELECT id FROM books WHERE deleted_at IS NOT NULL) GROUP BY 1")
def affected_rows(spark: SparkSession, d: str) -> DataFrame:
    return apply.affected_rows(table(spark, d, "data_rows"), table(spark, d, "books").where("deleted_at is not null"))


def _author() -> Column:
    return F.nullif(F.lower(F.trim("author_sort")), F.lit(""))


_MERGE = """d AS (SELECT id AS data_id, book AS book_id, upper(trim(coalesce(format, ''))) AS format FROM data_rows WHERE book IS NOT NULL), n AS (SELECT book_id, count(*) AS n FROM d GROUP BY 1),
    s AS (SELECT b.book_id, b.block, coalesce(n.n, 0) AS n, row_number() OVER (PARTITION BY b.block ORDER BY coalesce(n.n, 0) DESC, b.book_id) AS rank, count(*) OVER (PARTITION BY b.block) AS books FROM b LEFT JOIN n ON b.book_id = n.book_id),
    w AS (SELECT block, book_id AS winner_id FROM s WHERE rank = 1 AND books > 1), l AS (SELECT s.block, winner_id, s.book_id AS loser_id, d.data_id, d.format FROM s JOIN w ON s.block = w.block LEFT JOIN d ON d.book_id = s.book_id WHERE s.book_id <> winner_id),
    plan AS (SELECT l.*, data_id IS NOT NULL AND format <> '' AND NOT EXISTS (SELECT 1 FROM d WHERE d.book_id = winner_id AND d.format = l.format) AND row_number() OVER (PARTITION BY block, format ORDER BY loser_id, data_id) = 1 AS moved FROM l)"""


#: Books of one author as one block, so that blocks have several books with several files each.
_BLOCKS = "b AS (SELECT id AS book_id, lower(trim(author_sort)) AS block FROM books WHERE trim(author_sort) <> '')"


@query(f"WITH {_BLOCKS}, {_MERGE} SELECT block, winner_id, loser_id, data_id, format, moved FROM plan")
def merge_plan_books(spark: SparkSession, d: str) -> DataFrame:
    """Books with several files each: most files win, several losers claim one format."""
    lib = library(spark, d)
    return merge.plan(lib["books"], lib["data"], _author())


@query(f"WITH {_BLOCKS}, {_MERGE} SELECT r.id, CASE WHEN plan.moved THEN plan.winner_id ELSE r.book END AS book FROM data_rows r LEFT JOIN plan ON r.id = plan.data_id WHERE plan.data_id IS NULL OR plan.moved")
def merge_apply_books(spark: SparkSession, d: str) -> DataFrame:
    lib = library(spark, d)
    return merge.apply(lib, merge.plan(lib["books"], lib["data"], _author()))["data"].select("id", "book")


@query(f"WITH {_BLOCKS}, {_MERGE} SELECT data_id, CASE WHEN moved THEN 'quarantine_file' ELSE 'delete_file' END AS action FROM plan WHERE data_id IS NOT NULL")
def merge_deletions_books(spark: SparkSession, d: str) -> DataFrame:
    lib = library(spark, d)
    p = merge.plan(lib["books"], lib["data"], _author())
    return merge.merge_deletions(lib["data"], merge.apply(lib, p)["data"], p)


@query(
    f"""WITH b AS (SELECT id AS book_id, '未知/' || coalesce(substr(title, 1, 1), '') AS block FROM books WHERE path LIKE '未知/%'), {_MERGE}
    SELECT 'U' || lpad(dense_rank() OVER (ORDER BY block)::VARCHAR, 4, '0') AS merge_group, winner_id, loser_id, data_id, format, moved FROM plan WHERE block IS NOT NULL"""
)
def merge_review_groups(spark: SparkSession, d: str) -> DataFrame:
    """Books of unknown origin by the first letter of the title, for people."""
    lib = library(spark, d)
    prefix = F.when(F.startswith(F.col("path"), F.lit("未知/")), F.concat(F.lit("未知/"), F.substring(text.blank("title"), 1, 1)))
    return merge.review_groups(lib["books"], lib["data"], prefix).select("merge_group", "winner_id", "loser_id", "data_id", "format", "moved")


@query(
    f"""WITH f AS (SELECT book_id, data_id, regexp_replace(relative_path, '/?[^/]*$', '') AS folder FROM book_files WHERE lower(trim(coalesce(ext, ''))) NOT IN ({_FORMATS}) AND relative_path <> ''),
    g AS (SELECT CASE WHEN folder = '' THEN '.' ELSE folder END AS folder, min({{'none': book_id IS NULL, 'b': coalesce(book_id, 0)}}) AS fst FROM f GROUP BY 1),
    e AS (SELECT CASE WHEN fst.none THEN '' ELSE fst.b::VARCHAR END AS b, regexp_replace(replace(replace(folder, '/', chr(92)), '%', '%%'), '([\\^&|<>])', '^\\1', 'g') AS x FROM g), l AS (SELECT b, '"Q:' || chr(92) || x || '"' AS q, '"L:' || chr(92) || x || '"' AS l FROM e)
    SELECT 'REM rollback book_id=' || b AS line FROM l UNION ALL SELECT 'if not exist ' || q || ' echo SKIP: ' || q FROM l UNION ALL SELECT 'if exist ' || q || ' move /Y ' || q || ' ' || l FROM l"""
)
def rollback_text(spark: SparkSession, d: str) -> DataFrame:
    plan = table(spark, d, "book_files").where(dedup.not_target("ext", TARGET_FORMATS)).select("book_id", "data_id", "relative_path", F.lit("delete_file").alias("action"))
    return apply.rollback_lines(plan, "L:", "Q:").select("line")


@query("WITH e AS (SELECT DISTINCT relative_path FROM scan_batches WHERE relative_path IS NOT NULL), p AS (SELECT DISTINCT relative_path FROM book_files WHERE file_exists) SELECT relative_path, CASE WHEN relative_path IN (SELECT relative_path FROM p WHERE relative_path IS NOT NULL) THEN 'existing' ELSE 'missing' END AS status FROM e")
def verification_log(spark: SparkSession, d: str) -> DataFrame:
    return apply.verification_log(table(spark, d, "scan_batches"), table(spark, d, "book_files").where("file_exists")).select("relative_path", "status")


@query(
    """WITH w AS (SELECT DISTINCT relative_path AS p FROM book_files WHERE relative_path <> ''), s AS (SELECT relative_path AS p, max(actual_bytes) AS n FROM book_files WHERE file_exists GROUP BY 1), t AS (SELECT relative_path AS p, max(bytes) AS n FROM book_files GROUP BY 1)
    SELECT w.p AS relative_path, s.n AS bytes, CASE WHEN s.p IS NULL THEN 'file_missing' WHEN t.p IS NOT NULL AND s.n IS NOT DISTINCT FROM t.n THEN 'already_synced' ELSE 'copy' END AS status FROM w LEFT JOIN s ON w.p = s.p LEFT JOIN t ON w.p = t.p"""
)
def copy_plan(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "book_files")
    return apply.copy_plan(f, f.where("file_exists"), f.select("relative_path", F.col("bytes").alias("actual_bytes")))


@query(
    """WITH v AS (SELECT DISTINCT trim(coalesce(collection, '')) AS value FROM documents), w AS (SELECT * FROM v WHERE value <> '')
    SELECT row_number() OVER (ORDER BY value) AS id, value, nullif(trim(split_part(value, '-', 1)), '') AS level_1, CASE WHEN contains(value, '-') THEN nullif(trim(substr(value, strpos(value, '-') + 1)), '') END AS level_2 FROM w"""
)
def course_dimension(spark: SparkSession, d: str) -> DataFrame:
    return courses.dimension(table(spark, d, "documents"), "collection", 2, "-")


@query(
    """WITH n AS (SELECT book_id, count(*) AS n FROM scan_batches WHERE batch > '2024-06-30' GROUP BY 1), o AS (SELECT book_id, count(*) AS n FROM scan_batches WHERE batch <= '2024-06-30' GROUP BY 1)
    SELECT coalesce(n.book_id, o.book_id) AS book_id, CASE WHEN o.book_id IS NULL THEN 'insert_course' WHEN n.book_id IS NULL THEN 'report_only' WHEN n.n > o.n THEN 'insert_files' ELSE 'keep_target' END AS action FROM n FULL JOIN o ON n.book_id = o.book_id"""
)
def course_actions(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "scan_batches")
    one = lambda c: s.where(c).groupBy("book_id").agg(F.count("*").alias("n_files"))
    return courses.diff_courses(one("batch > '2024-06-30'"), one("batch <= '2024-06-30'"), ["book_id"])


@query(
    """SELECT 'orphan_data' AS "check", count(*) AS n FROM data_rows WHERE book NOT IN (SELECT id FROM books) UNION ALL SELECT 'orphan_books_seen_link', count(*) FROM book_files WHERE book_id IS NULL OR book_id NOT IN (SELECT id FROM books)
    UNION ALL SELECT 'empty_books', count(*) FROM books WHERE id NOT IN (SELECT book FROM data_rows WHERE book IS NOT NULL) UNION ALL SELECT 'duplicate_formats', count(*) FROM (SELECT book, format FROM data_rows GROUP BY ALL HAVING count(*) > 1)"""
)
def integrity_links(spark: SparkSession, d: str) -> DataFrame:
    """With a link table that has orphans."""
    link = table(spark, d, "book_files").select(F.col("book_id").alias("book"), F.col("data_id").alias("seen"))
    return checks.integrity(library(spark, d).replace(books_seen_link=link))


_LIT = "'''' || replace({0}, '''', '''''') || ''''"


@query(
    f"""WITH h AS (SELECT book_id, data_id, coalesce(reason_code, '') AS reason, CASE WHEN lower(trim(coalesce(human_decision, ''))) <> '' THEN lower(trim(human_decision)) ELSE trim(coalesce(recommended_action, '')) END AS a0, coalesce(human_title, '') AS t, coalesce(human_file_basename, '') AS n FROM manual_reviews),
    p AS (SELECT *, CASE WHEN a0 IN ({", ".join(f"'{a}'" for a in CLEAN_ACTIONS)}) THEN a0 ELSE 'keep' END AS action FROM h),
    gone AS (SELECT book_id FROM p GROUP BY 1 HAVING count(*) FILTER (action <> 'delete_file') = 0)
    SELECT '-- action=' || action || ' reason=' || reason || ' book_id=' || book_id || ' data_id=' || data_id AS line FROM p WHERE action IN ('delete_file', 'update_metadata') UNION ALL SELECT 'DELETE FROM data WHERE id = ' || data_id || ';' FROM p WHERE action = 'delete_file'
    UNION ALL SELECT 'UPDATE books SET title = ' || {_LIT.format("t")} || ' WHERE id = ' || book_id || ';' FROM p WHERE action = 'update_metadata' AND t <> '' UNION ALL SELECT 'UPDATE data SET name = ' || {_LIT.format("n")} || ' WHERE id = ' || data_id || ';' FROM p WHERE action = 'update_metadata' AND n <> ''
    UNION ALL SELECT '-- action=' || action || ' data_id=' || data_id || '; no SQL operation' FROM p WHERE action NOT IN ('delete_file', 'update_metadata') UNION ALL SELECT 'DELETE FROM books WHERE id = ' || book_id || ' AND NOT EXISTS (SELECT 1 FROM data WHERE book = ' || book_id || ');' FROM gone
    UNION ALL SELECT unnest(['-- batch: b1', 'BEGIN TRANSACTION;', 'DELETE FROM "comments" WHERE book NOT IN (SELECT id FROM books);', 'DELETE FROM "identifiers" WHERE book NOT IN (SELECT id FROM books);', 'COMMIT;'])"""
)
def sql_plan_actions(spark: SparkSession, d: str) -> DataFrame:
    """Every action, book statements and sweeps."""
    r = table(spark, d, "manual_reviews").withColumn("action", classify.resolve_action("human_decision", "recommended_action", CLEAN_ACTIONS, "keep"))
    p = r.select("book_id", "data_id", "reason_code", "action", F.col("human_title").alias("new_title"), F.col("human_file_basename").alias("new_file_basename"))
    gone = p.groupBy("book_id").agg(F.count_if(F.col("action") != "delete_file").alias("n")).where("n = 0").select("book_id")
    return apply.sql_lines(p, gone, ["data", "identifiers", "comments"], "b1").select("line")


@query(f"SELECT string_agg(v || '(' || n || ')', ', ' ORDER BY n DESC, v) AS line FROM (SELECT CASE WHEN trim(coalesce(lang, '')) = '' THEN '-' ELSE lang END AS v, count(*) AS n FROM documents GROUP BY 1)")
def summary_line(spark: SparkSession, d: str) -> DataFrame:
    return reports.summary(table(spark, d, "documents"), "lang")


@query("SELECT source, doc_id FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC NULLS LAST, doc_id) AS r FROM documents) WHERE r <= 5")
def log_examples(spark: SparkSession, d: str) -> DataFrame:
    """The five longest texts of each source: a top-k report."""
    t = table(spark, d, "documents").select("source", "doc_id", (-F.coalesce("n_chars", F.lit(-1))).alias("o"))
    return reports.examples(t, ["source"], ["o", "doc_id"]).select("source", "doc_id")


@query(
    f"""WITH p AS (SELECT id FROM data_rows WHERE {_OTHER}), w AS (SELECT id FROM data_rows WHERE {_OTHER} OR deleted_at IS NOT NULL), a AS (SELECT id FROM data_rows WHERE deleted_at IS NULL)
    SELECT 'planned_not_written' AS "check", count(*) AS n FROM p WHERE id NOT IN (SELECT id FROM w) UNION ALL SELECT 'written_not_planned', count(*) FROM w WHERE id NOT IN (SELECT id FROM p) UNION ALL SELECT 'still_there', count(*) FROM p WHERE id IN (SELECT id FROM a)
    UNION ALL SELECT 'gone_without_plan', count(*) FROM data_rows WHERE id NOT IN (SELECT id FROM a) AND id NOT IN (SELECT id FROM p)"""
)
def three_way_check(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "data_rows")
    other = dedup.not_target("format", TARGET_FORMATS)
    return checks.three_way(rows.where(other), rows.where(other | F.col("deleted_at").isNotNull()), rows, rows.where("deleted_at is null"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(Q)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
