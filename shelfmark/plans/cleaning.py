"""Queries of deduplication, filters, scans, plans and checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions import codec, text
from shelfmark.functions.ids import stable_id, sync_id, with_surrogate
from shelfmark.functions.session import table
from shelfmark.operators import anomaly, apply, checks, classify, courses, dedup
from shelfmark.plans import sqltext as q
from shelfmark.rules import REASON_ORDER, RuleSet, TARGET_FORMATS, UNKNOWN_MARKERS
from shelfmark.sources.library import Library

#: Words of the generated texts, as a rule set for the queries.
WORDS = RuleSet(junk_keywords=("harbor", "灯塔", "lantern", "山谷", "Book 1"), copy_markers=("码头", "Canal"))

Q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        Q[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def library(spark: SparkSession, d: str) -> Library:
    b = table(spark, d, "books").select("id", "title", "sort", "author_sort", "path")
    return Library({"books": b, "data": table(spark, d, "data_rows").select("id", "book", "format", "uncompressed_size", "name")})


def records(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "dedup_records").select("book_id", "data_id", "title", "bytes", "init_path", F.lower(F.regexp_extract("relative_path", r"\.([^./]*)$", 1)).alias("ext"))
    return r.distinct()


REC = "rec AS (SELECT DISTINCT book_id, data_id, title, bytes, init_path, lower(regexp_extract(relative_path, '[.]([^./]*)$', 1)) AS ext FROM dedup_records)"
KEY = f"{q.normalize_title('title')} || '|' || coalesce(bytes, 0) || '|' || coalesce(init_path, '')"


@query(
    f"""WITH g AS (SELECT *, {q.normalize_title("p_name")} || '|' || p_type || '|' || p_size AS k FROM part)
    SELECT p_partkey AS part_id, p_name AS title, p_type AS ext, p_size AS bytes, k AS matched_value,
    CASE WHEN row_number() OVER (PARTITION BY k ORDER BY p_partkey) = 1 THEN 'keep' ELSE 'delete_file' END AS recommended_action
    FROM g QUALIFY count(*) OVER (PARTITION BY k) > 1"""
)
def dedup_keep_min(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    g = dedup.duplicate_groups(p, [text.normalize_title("p_name"), F.col("p_type"), F.col("p_size")], [F.col("p_partkey")])
    return dedup.with_action(g).select(F.col("p_partkey").alias("part_id"), F.col("p_name").alias("title"), F.col("p_type").alias("ext"), F.col("p_size").alias("bytes"), F.col("group_key").alias("matched_value"), "recommended_action")


@query(
    f"""WITH {REC}, g AS (SELECT data_id, {KEY} AS k FROM rec)
    SELECT data_id, count(*) OVER (PARTITION BY k) AS group_size,
    CASE WHEN row_number() OVER (PARTITION BY k ORDER BY data_id) = 1 THEN 'keep' ELSE 'delete_file' END AS recommended_action
    FROM g QUALIFY count(*) OVER (PARTITION BY k) > 1"""
)
def dedup_title_bytes_path(spark: SparkSession, d: str) -> DataFrame:
    g = dedup.duplicate_groups(records(spark, d), dedup.title_bytes_path_key(), [F.col("data_id")])
    return dedup.with_action(g).select("data_id", "group_size", "recommended_action")


@query(
    f"""WITH g AS (SELECT *, {q.normalize_title("p_name")} AS k FROM part), n AS (
      SELECT k, p_type, min(p_partkey) AS keep_id, count(*) AS group_size, string_agg(DISTINCT p_brand, '; ' ORDER BY p_brand) AS note FROM g GROUP BY k, p_type HAVING count(*) > 1)
    SELECT p_partkey, n.group_size, p_partkey = keep_id AS keep, note FROM g JOIN n ON g.k = n.k AND g.p_type = n.p_type"""
)
def dedup_compare_report(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    g = dedup.duplicate_groups(p, [text.normalize_title("p_name"), F.col("p_type")], [F.col("p_partkey")])
    brands = g.groupBy("group_key").agg(F.array_join(F.array_sort(F.collect_set("p_brand")), "; ").alias("note"))
    return g.join(brands, "group_key").select("p_partkey", "group_size", "keep", "note")


@query(
    f"""WITH f AS (SELECT DISTINCT data_id, title, ext, bytes, file_exists, file_basename, relative_path, actual_bytes FROM book_files WHERE data_id IS NOT NULL),
    g AS (SELECT *, {q.normalize_title("title")} || '|' || lower(coalesce(ext, '')) || '|' || coalesce(bytes, actual_bytes) AS k FROM f WHERE coalesce(bytes, actual_bytes) IS NOT NULL)
    SELECT data_id, relative_path, k AS group_key, dense_rank() OVER (PARTITION BY k ORDER BY CASE WHEN file_exists THEN 0 ELSE 1 END,
      CASE WHEN {q.first_hit("file_basename", UNKNOWN_MARKERS)} IS NOT NULL THEN 1 ELSE 0 END, length(coalesce(relative_path, '')), data_id) = 1 AS keep
    FROM g QUALIFY count(*) OVER (PARTITION BY k) > 1"""
)
def dedup_keep_priority(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "book_files").where("data_id is not null").select("data_id", "title", "ext", "bytes", "file_exists", "file_basename", "relative_path", "actual_bytes").distinct()
    g = dedup.duplicate_groups(f, dedup.title_ext_size_key(), dedup.keep_by_file("file_exists", "file_basename", "relative_path", "data_id"))
    return g.select("data_id", "relative_path", "group_key", "keep")


_FORMATS = ", ".join(f"'{f}'" for f in TARGET_FORMATS)
_CLEAN = f"""{REC}, g AS (SELECT *, {KEY} AS k, {q.first_hit("title", WORDS.junk_keywords)} AS junk, ext NOT IN ({_FORMATS}) AS other FROM rec),
    n AS (SELECT *, count(*) OVER (PARTITION BY k) > 1 AS dup, row_number() OVER (PARTITION BY k ORDER BY data_id) = 1 AS keep FROM g),
    c AS (SELECT book_id, data_id,
      CASE WHEN dup AND NOT keep THEN 'duplicate_title_bytes_initpath' WHEN junk IS NOT NULL THEN 'title_junk_keyword' WHEN other THEN 'non_target_format' WHEN dup THEN 'duplicate_title_bytes_initpath' END AS reason_code,
      CASE WHEN dup AND NOT keep THEN k WHEN junk IS NOT NULL THEN junk WHEN other THEN upper(ext) WHEN dup THEN k END AS matched_value,
      CASE WHEN (dup AND NOT keep) OR junk IS NOT NULL OR other THEN 'delete_file' ELSE 'keep' END AS recommended_action FROM n)"""


@query(f"WITH {_CLEAN} SELECT data_id, reason_code, matched_value, recommended_action FROM c")
def clean_first_step(spark: SparkSession, d: str) -> DataFrame:
    return dedup.clean(records(spark, d), WORDS).select("data_id", "reason_code", "matched_value", "recommended_action")


@query(f"WITH {_CLEAN} SELECT book_id FROM c GROUP BY book_id HAVING count(*) FILTER (recommended_action <> 'delete_file') = 0")
def clean_deleted_books(spark: SparkSession, d: str) -> DataFrame:
    return dedup.deleted_books(dedup.clean(records(spark, d), WORDS))


@query(f"SELECT doc_id, {q.first_hit('text', WORDS.junk_keywords)} AS keyword FROM documents WHERE {q.first_hit('text', WORDS.junk_keywords)} IS NOT NULL")
def junk_first_keyword(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", dedup.first_hit("text", WORDS.junk_keywords).alias("keyword")).where("keyword is not null")


@query(f"SELECT id, book, upper(trim(format)) AS matched_value FROM data_rows WHERE lower(trim(coalesce(format, ''))) NOT IN ({_FORMATS})")
def non_target_format(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "data_rows").where(dedup.not_target("format", TARGET_FORMATS)).select("id", "book", F.upper(F.trim("format")).alias("matched_value"))


_REASONS = " ".join(f"WHEN '{k}' THEN {v}" for k, v in REASON_ORDER.items())


@query(
    f"""WITH f AS (SELECT * FROM book_files WHERE data_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY data_id ORDER BY seen_at, batch, relative_path, title) = 1),
    j AS (SELECT *, {q.first_hit("title", WORDS.junk_keywords)} AS junk, contains(coalesce(title, ''), chr(65533)) AS bad FROM f),
    l AS (SELECT *, {q.normalize_title("title")} || '|' || lower(coalesce(ext, '')) || '|' || coalesce(bytes, actual_bytes) AS k FROM j WHERE junk IS NULL AND NOT bad AND coalesce(bytes, actual_bytes) IS NOT NULL),
    u AS (SELECT data_id, k, row_number() OVER (PARTITION BY k ORDER BY CASE WHEN file_exists THEN 0 ELSE 1 END, CASE WHEN {q.first_hit("file_basename", UNKNOWN_MARKERS)} IS NOT NULL THEN 1 ELSE 0 END,
      length(coalesce(relative_path, '')), data_id) = 1 AS keep FROM l QUALIFY count(*) OVER (PARTITION BY k) > 1),
    r AS (SELECT j.data_id, CASE WHEN junk IS NOT NULL THEN 'title_junk_keyword' WHEN bad THEN 'title_mojibake' WHEN u.k IS NOT NULL THEN 'duplicate_title_ext_bytes'
      WHEN lower(trim(coalesce(ext, ''))) NOT IN ({_FORMATS}) THEN 'non_target_format' WHEN {q.first_hit("title", WORDS.copy_markers)} IS NOT NULL THEN 'title_copy'
      WHEN {q.first_hit("file_basename", UNKNOWN_MARKERS)} IS NOT NULL THEN 'file_basename_unknown' END AS reason_code,
      CASE WHEN junk IS NOT NULL THEN 'delete_file' WHEN bad THEN 'keep' WHEN u.k IS NOT NULL THEN CASE WHEN keep THEN 'keep' ELSE 'delete_file' END
      WHEN lower(trim(coalesce(ext, ''))) NOT IN ({_FORMATS}) THEN 'delete_file' WHEN {q.first_hit("title", WORDS.copy_markers)} IS NOT NULL THEN 'keep'
      WHEN {q.first_hit("file_basename", UNKNOWN_MARKERS)} IS NOT NULL THEN 'keep' END AS recommended_action FROM j LEFT JOIN u ON j.data_id = u.data_id)
    SELECT data_id, reason_code, recommended_action, CASE reason_code {_REASONS} END AS reason_order FROM r"""
)
def rule_waterfall(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "book_files").where("data_id is not null")
    first = f.groupBy("data_id").agg(F.min(F.struct("seen_at", "batch", "relative_path", "title", "ext", "bytes", "actual_bytes", "file_basename", "file_exists")).alias("f")).select("data_id", "f.*")
    return classify.waterfall(first, codec.is_mojibake("title"), WORDS).select("data_id", "reason_code", "recommended_action", "reason_order")


@query(
    """WITH p AS (SELECT book_id AS book, count(DISTINCT trim(custom_column_1_value)) AS n, min(trim(custom_column_1_value)) AS p FROM book_files
      WHERE book_id IS NOT NULL AND trim(coalesce(custom_column_1_value, '')) <> '' GROUP BY 1),
    r AS (SELECT b.id, b.title, n, p, CASE WHEN coalesce(n, 0) = 0 THEN 'missing_book_init_path' WHEN n > 1 THEN 'ambiguous_book_init_path' ELSE '' END AS why,
      trim(regexp_extract(trim(regexp_extract(coalesce(p, ''), '([^/' || chr(92) || chr(92) || ']*)$', 1)), '^(.+)[.][^.]+$', 1)) AS stem FROM books b LEFT JOIN p ON b.id = p.book
      WHERE contains(coalesce(b.title, ''), '码头') OR contains(coalesce(b.title, ''), 'Canal')),
    s AS (SELECT id, CASE WHEN why <> '' THEN why WHEN stem = '' THEN 'invalid_book_init_path' WHEN contains(stem, '码头') OR contains(stem, 'Canal') THEN 'filename_still_has_marker' ELSE '' END AS reason_code, stem FROM r)
    SELECT id, reason_code, CASE WHEN reason_code = '' THEN stem ELSE '' END AS candidate, CASE WHEN reason_code = '' THEN 'update_file' ELSE 'manual_confirming' END AS status FROM s"""
)
def copy_marker_handoff(spark: SparkSession, d: str) -> DataFrame:
    paths = table(spark, d, "book_files").select(F.col("book_id").alias("book"), F.trim("custom_column_1_value").alias("path")).where("book is not null and path <> ''").distinct()
    return anomaly.title_handoffs(table(spark, d, "books").select("id", "title"), paths, WORDS).select("id", "reason_code", "candidate", "status")


_DICT = "SELECT {0} AS target, '{1}' AS \"table\", 'name' AS \"column\", row_number() OVER (ORDER BY v) AS row_id, v AS value FROM (SELECT DISTINCT {2} AS v FROM {3}) WHERE v <> ''"


@query(
    f"""SELECT 0 AS target, 'books' AS "table", 'title' AS "column", id AS row_id, title AS value FROM books WHERE title <> '' UNION ALL SELECT 1, 'books', 'sort', id, sort FROM books WHERE sort <> ''
    UNION ALL SELECT 2, 'books', 'author_sort', id, author_sort FROM books WHERE author_sort <> '' UNION ALL SELECT 10, 'data', 'name', id, name FROM data_rows WHERE name <> ''
    UNION ALL SELECT 11, 'books', 'path', id, path FROM books WHERE path <> '' UNION ALL {_DICT.format(3, "authors", "trim(author_sort)", "books")} UNION ALL {_DICT.format(5, "series", "trim(series)", "scan_compare")}
    UNION ALL {_DICT.format(7, "publishers", "trim(publisher)", "scan_compare")} UNION ALL {_DICT.format(9, "tags", "trim(t)", "(SELECT unnest(string_split(tags, ';')) AS t FROM scan_compare)")}
    UNION ALL SELECT target + 1, "table", 'sort', row_id, upper(value) FROM ({_DICT.format(3, "authors", "trim(author_sort)", "books")} UNION ALL {_DICT.format(5, "series", "trim(series)", "scan_compare")} UNION ALL {_DICT.format(7, "publishers", "trim(publisher)", "scan_compare")})"""
)
def unpivot_scan(spark: SparkSession, d: str) -> DataFrame:
    """All twelve columns; the dictionaries are made from the tables' texts, with upper case as the sort name."""
    scan = table(spark, d, "scan_compare")
    names = {"authors": table(spark, d, "books").select(F.trim("author_sort").alias("name")), "tags": scan.select(F.explode(F.split("tags", ";")).alias("name")).select(F.trim("name").alias("name"))}
    names |= {n: scan.select(F.trim(c).alias("name")) for n, c in (("series", "series"), ("publishers", "publisher"))}
    rows = {n: with_surrogate(v.where("name <> ''").distinct(), "id", ["name"]) for n, v in names.items()}
    rows = {n: v if n == "tags" else v.withColumn("sort", F.upper("name")) for n, v in rows.items()}
    return anomaly.unpivot(library(spark, d).replace(**rows))


@query()
def garbled_scan(spark: SparkSession, d: str) -> DataFrame:
    """restore_text over all stored titles: built on codecs that SQL lacks."""
    t = table(spark, d, "dedup_records").select("data_id", "title").distinct().withColumn("r", codec.restore_text("title"))
    return t.select("data_id", "title", F.col("r.restored").alias("restored"), F.col("r.chain").alias("chain"), codec.partial_hint("title").alias("hint")).where("restored is not null or hint <> ''")


@query(
    """SELECT b.id, coalesce(p.init_path, '') AS init_path FROM books b LEFT JOIN (
      SELECT book_id, string_agg(DISTINCT trim(custom_column_1_value), '; ' ORDER BY trim(custom_column_1_value)) AS init_path FROM book_files WHERE trim(custom_column_1_value) <> '' GROUP BY 1) p ON b.id = p.book_id"""
)
def adaptive_left_join(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "book_files").where("book_id is not null").select(F.col("book_id").alias("book"), F.col("custom_column_1_value").alias("value"))
    lib = library(spark, d).replace(custom_column_1=c)
    return lib["books"].join(lib.init_paths().withColumnRenamed("book", "id"), "id", "left").select("id", F.coalesce("init_path", F.lit("")).alias("init_path"))


@query(
    """SELECT d.id AS data_id, CASE WHEN trim(coalesce(b.path, '')) = '' THEN trim(d.name) || '.' || lower(trim(d.format)) ELSE trim(b.path) || CASE WHEN trim(coalesce(d.name, '')) = '' THEN ''
      ELSE '/' || trim(d.name) || CASE WHEN trim(coalesce(d.format, '')) = '' THEN '' ELSE '.' || lower(trim(d.format)) END END END AS relative_path, coalesce(d.uncompressed_size, 0) AS bytes FROM books b JOIN data_rows d ON d.book = b.id"""
)
def book_file_scan(spark: SparkSession, d: str) -> DataFrame:
    return library(spark, d).dedup_records().select("data_id", "relative_path", "bytes")


@query("SELECT d.id FROM data_rows d WHERE NOT EXISTS (SELECT 1 FROM books b WHERE b.id = d.book AND b.deleted_at IS NULL)")
def orphan_children(spark: SparkSession, d: str) -> DataFrame:
    live = table(spark, d, "books").where("deleted_at is null").select(F.col("id").alias("_b"))
    return table(spark, d, "data_rows").join(live, F.col("book") == F.col("_b"), "left_anti").select("id")


@query("SELECT o_orderkey AS id FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def empty_parents(spark: SparkSession, d: str) -> DataFrame:
    return apply.empty_parents(table(spark, d, "orders").select(F.col("o_orderkey").alias("id")), table(spark, d, "lineitem").select(F.col("l_orderkey").alias("book")))


@query("SELECT book, upper(format) AS format, count(*) AS n FROM data_rows GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_child_key(spark: SparkSession, d: str) -> DataFrame:
    return checks.duplicate_keys(table(spark, d, "data_rows").select("book", F.upper("format").alias("format")), ["book", "format"])


@query("SELECT l_orderkey AS book FROM lineitem GROUP BY 1 HAVING count(*) FILTER (l_returnflag <> 'R') = 0")
def fully_deleted_parents(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("book"), F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag")]).alias("id"), "l_returnflag")
    return apply.fully_deleted(li, li.where("l_returnflag = 'R'").select("id"))


@query(
    f"""WITH gone AS (SELECT id, book FROM data_rows WHERE lower(trim(coalesce(format, ''))) NOT IN ({_FORMATS})),
    kept AS (SELECT book FROM data_rows WHERE id NOT IN (SELECT id FROM gone))
    SELECT id FROM books WHERE NOT (id IN (SELECT book FROM gone) AND id NOT IN (SELECT book FROM kept))"""
)
def guarded_delete(spark: SparkSession, d: str) -> DataFrame:
    lib = library(spark, d)
    return lib.delete(lib["data"].where(dedup.not_target("format", TARGET_FORMATS)).select("id"))["books"].select("id")


@query('SELECT \'orphan_data\' AS "check", count(*) AS n FROM data_rows WHERE book NOT IN (SELECT id FROM books) UNION ALL SELECT \'empty_books\', count(*) FROM books WHERE id NOT IN (SELECT book FROM data_rows WHERE book IS NOT NULL) UNION ALL SELECT \'duplicate_formats\', count(*) FROM (SELECT book, format FROM data_rows GROUP BY ALL HAVING count(*) > 1)')
def integrity_checks(spark: SparkSession, d: str) -> DataFrame:
    return checks.integrity(library(spark, d))


@query("SELECT lower(ext) AS ext, count(*) AS n FROM book_files GROUP BY 1")
def format_counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "book_files").groupBy(F.lower("ext").alias("ext")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "ext")


@query("SELECT batch, count(*) FILTER (file_exists) AS present, count(*) FILTER (bytes IS NULL) AS no_size, count(DISTINCT book_id) AS books FROM book_files GROUP BY 1")
def conditional_counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "book_files").groupBy("batch").agg(F.count_if("file_exists").alias("present"), F.count_if(F.col("bytes").isNull()).alias("no_size"), F.count_distinct("book_id").alias("books"))


@query("WITH b AS (SELECT DISTINCT data_id AS id FROM book_files WHERE data_id IS NOT NULL), a AS (SELECT id FROM data_rows WHERE deleted_at IS NULL) SELECT id, 'removed' AS change FROM (SELECT id FROM b EXCEPT SELECT id FROM a) UNION ALL SELECT id, 'added' FROM (SELECT id FROM a EXCEPT SELECT id FROM b)")
def id_set_diff(spark: SparkSession, d: str) -> DataFrame:
    return checks.id_diff(table(spark, d, "book_files").where("data_id is not null").select(F.col("data_id").alias("id")), table(spark, d, "data_rows").where("deleted_at is null"))


@query("SELECT review_id, substr(sha1(batch || '|' || coalesce(book_id::VARCHAR, '') || '|' || coalesce(data_id::VARCHAR, '') || '|' || coalesce(reason_code, '') || '|' || coalesce(matched_value, '')), 1, 16) AS stable_id FROM manual_reviews")
def stable_ids(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "manual_reviews").select("review_id", stable_id("batch", "book_id", "data_id", "reason_code", "matched_value").alias("stable_id"))


_UUID = "sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode(batch || '|' || coalesce(book_id::VARCHAR, '') || '|' || coalesce(data_id::VARCHAR, '') || '|' || coalesce(reason_code, '')))"


@query(f"SELECT review_id, substr({_UUID}, 1, 12) || '5' || substr({_UUID}, 14, 3) AS sync_id FROM manual_reviews")
def sync_ids(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "manual_reviews").select("review_id", sync_id("batch", "book_id", "data_id", "reason_code").alias("sync_id"))


@query(f"SELECT id, {q.normalize_title('title')} AS title_key, CASE WHEN {q.normalize('author_sort')} = '' THEN {q.normalize('title')} ELSE {q.normalize('title')} || '|' || {q.normalize('author_sort')} END AS book_key FROM books")
def title_keys(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "books").select("id", text.normalize_title("title").alias("title_key"), text.book_key("title", "author_sort").alias("book_key"))


@query("SELECT id, round(CASE WHEN coalesce(title, '') = '' THEN 0 ELSE length(regexp_replace(title, '[^一-鿿]', '', 'g')) / length(title) END, 6) AS ratio, contains(coalesce(title, ''), chr(65533)) AS damaged FROM books")
def cjk_ratios(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "books").select("id", F.round(text.cjk_ratio("title"), 6).alias("ratio"), text.replacement_damaged("title").alias("damaged"))


_NAME = q.strip("regexp_extract(coalesce(init_path, ''), '([^/' || chr(92) || chr(92) || ']*)$', 1)")


@query(
    f"""WITH p AS (SELECT DISTINCT init_path, {_NAME} AS name FROM dedup_records)
    SELECT init_path, nullif({q.strip("regexp_extract(name, '(?s)^(.+)[.][^.]+$', 1)")}, '') AS stem, nullif(lower(regexp_extract(name, '(?s)^.+[.]([^.]+)$', 1)), '') AS suffix FROM p"""
)
def path_parts(spark: SparkSession, d: str) -> DataFrame:
    """Every path, dirty ones too; a null path is a row with neither stem nor suffix."""
    p = table(spark, d, "dedup_records").select("init_path").distinct()
    return p.select("init_path", text.path_stem("init_path").alias("stem"), text.path_suffix("init_path").alias("suffix"))


@query("SELECT review_id, coalesce(try_cast(book_id AS BIGINT), 0) AS book, coalesce(try_cast(human_decision AS BIGINT), 1000000000000) AS sort_key FROM manual_reviews")
def numeric_text_key(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "manual_reviews").select("review_id", text.to_int("book_id").alias("book"), text.to_int("human_decision", 10**12).alias("sort_key"))


@query("SELECT id, '''' || replace(coalesce(title, ''), '''', '''''') || '''' AS literal, regexp_replace(replace(coalesce(title, ''), '%', '%%'), '([\\^&|<>])', '^\\1', 'g') AS argument FROM books")
def quoting(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "books").select("id", text.sql_quote("title").alias("literal"), text.bat_quote("title").alias("argument"))


@query("SELECT p_brand, max(p_brand) || '/' AS folder, row_number() OVER (ORDER BY p_brand) + 100 AS id FROM part GROUP BY 1")
def surrogate_ids(spark: SparkSession, d: str) -> DataFrame:
    return with_surrogate(table(spark, d, "part").select("p_brand").distinct().withColumn("folder", F.concat("p_brand", F.lit("/"))), "id", ["p_brand"], start=100)


@query(
    f"""WITH p AS (SELECT d.book AS book_id, d.id AS data_id FROM data_rows d WHERE lower(trim(coalesce(format, ''))) NOT IN ({_FORMATS}))
    SELECT 'DELETE FROM data WHERE id = ' || data_id || ';' AS line FROM p UNION ALL SELECT '-- action=delete_file reason=non_target_format book_id=' || book_id || ' data_id=' || data_id FROM p
    UNION ALL SELECT '-- batch: b1' UNION ALL SELECT 'BEGIN TRANSACTION;' UNION ALL SELECT 'COMMIT;'"""
)
def sql_plan_text(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "data_rows").where(dedup.not_target("format", TARGET_FORMATS)).select(F.col("book").alias("book_id"), F.col("id").alias("data_id"), F.lit("non_target_format").alias("reason_code"), F.lit("delete_file").alias("action"), F.lit("").alias("new_title"), F.lit("").alias("new_file_basename"))
    return apply.sql_lines(p, p.select("book_id").limit(0), ["data"], "b1").select("line")


@query("SELECT o_orderpriority AS action, count(*) AS n FROM orders GROUP BY 1")
def action_counts(spark: SparkSession, d: str) -> DataFrame:
    return apply.action_counts(table(spark, d, "orders").select(F.col("o_orderpriority").alias("action")))


@query("WITH h AS (SELECT review_id, lower(trim(coalesce(human_decision, ''))) AS h, trim(coalesce(human_decision, '')) AS raw, recommended_action FROM manual_reviews) SELECT review_id, CASE WHEN raw = '' THEN 'manual_required' WHEN raw NOT IN ('delete_file', 'quarantine_file', 'update_metadata', 'keep') THEN 'invalid_action' ELSE 'ready' END AS check_status, CASE WHEN (CASE WHEN h <> '' THEN h ELSE trim(coalesce(recommended_action, '')) END) IN ('delete_file', 'quarantine_file', 'update_metadata', 'keep') THEN (CASE WHEN h <> '' THEN h ELSE trim(coalesce(recommended_action, '')) END) ELSE 'keep' END AS action FROM h")
def decisions(spark: SparkSession, d: str) -> DataFrame:
    from shelfmark.rules import CLEAN_ACTIONS

    return table(spark, d, "manual_reviews").select("review_id", classify.check_status("human_decision", CLEAN_ACTIONS).alias("check_status"), classify.resolve_action("human_decision", "recommended_action", CLEAN_ACTIONS, "keep").alias("action"))


@query("SELECT book_id, max(CASE WHEN trim(coalesce(human_decision, '')) <> '' THEN human_decision END) AS human_decision FROM manual_reviews GROUP BY 1")
def human_carryover(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "manual_reviews")
    new = r.select("book_id").distinct().withColumn("human_decision", F.lit(None).cast("string"))
    return classify.carry_over(new, r.select("book_id", "human_decision"), ["book_id"], ["human_decision"])


@query("SELECT book, string_agg(id, ', ' ORDER BY id) AS data_ids FROM data_rows GROUP BY 1")
def data_ids_by_book(spark: SparkSession, d: str) -> DataFrame:
    return anomaly.ids_by_book(table(spark, d, "data_rows"))


@query("WITH p AS (SELECT DISTINCT relative_path FROM scan_batches) SELECT relative_path, split_part(coalesce(relative_path, ''), '/', 1) AS dir_1, " + ", ".join(f"list_extract(string_split(coalesce(relative_path, ''), '/'), {i}) AS dir_{i}" for i in range(2, 7)) + " FROM p")
def course_paths(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "scan_batches").select("relative_path").distinct().select("relative_path", *courses.split_path("relative_path"))


@query("SELECT term, data_id, count(*) AS n FROM (SELECT data_id, unnest(string_split_regex(lower(concat_ws(' ', title, author)), '[^\\p{L}\\p{N}]+')) AS term FROM scan_batches) WHERE term <> '' GROUP BY 1, 2")
def title_index(spark: SparkSession, d: str) -> DataFrame:
    return courses.inverted_index(table(spark, d, "scan_batches"), "data_id", ["title", "author"])


@query("SELECT id, row_number() OVER (ORDER BY author_sort NULLS FIRST, id) AS serial FROM books")
def report_serial(spark: SparkSession, d: str) -> DataFrame:
    return with_surrogate(table(spark, d, "books").select("id", "author_sort"), "serial", ["author_sort", "id"]).select("id", "serial")


@query(f"SELECT id, regexp_full_match(coalesce(title, ''), '[{''.join(f'\\x{{{a:x}}}-\\x{{{b:x}}}' for a, b in text.ORDINARY)}]*') AS ordinary FROM books")
def ordinary_titles(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "books").select("id", text.ordinary_only("title").alias("ordinary"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(Q)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
