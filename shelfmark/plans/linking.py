"""Queries of merging, matching, comparing and upserting."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfmark.functions.session import table
from shelfmark.functions.text import strip
from shelfmark.operators import apply, compare, merge, upsert
from shelfmark.plans import sqltext as q
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


def parts(spark: SparkSession, d: str) -> Library:
    """Parts as books by name and brand, each with one file whose format is its type and size."""
    p = table(spark, d, "part")
    b = p.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("title"), F.col("p_brand").alias("author_sort"), F.concat("p_brand", F.lit("/"), "p_name", F.lit(" ("), F.col("p_partkey").cast("string"), F.lit(")")).alias("path"))
    return Library({"books": b, "data": p.select(F.col("p_partkey").alias("id"), F.col("p_partkey").alias("book"), F.col("p_type").alias("format"), F.col("p_size").cast("long").alias("uncompressed_size"), F.col("p_name").alias("name"))})


def _plan_sql(block: str) -> str:
    return f"""b AS (SELECT p_partkey AS id, upper(trim(p_type)) AS f, {block} AS block FROM part),
    w AS (SELECT block, min(id) AS winner_id FROM b GROUP BY 1 HAVING count(*) > 1),
    l AS (SELECT b.block, winner_id, id AS loser_id, id AS data_id, f AS format FROM b JOIN w ON b.block = w.block WHERE id <> winner_id),
    plan AS (SELECT l.*, row_number() OVER (PARTITION BY l.block, format ORDER BY loser_id, data_id) = 1 AND format <> (SELECT f FROM b WHERE id = winner_id) AS moved FROM l)"""


_TA = f"{q.normalize_title('p_name')} || '|' || lower(trim(p_brand))"
_PRE = "p_brand || '/' || p_name"


@query(f"WITH {_plan_sql(_TA)} SELECT block, winner_id, loser_id, data_id, format, moved FROM plan")
def merge_plan_title_author(spark: SparkSession, d: str) -> DataFrame:
    lib = parts(spark, d)
    return merge.plan(lib["books"], lib["data"], merge.title_author())


@query(f"WITH {_plan_sql(_PRE)} SELECT 'G' || lpad(dense_rank() OVER (ORDER BY block)::VARCHAR, 4, '0') AS merge_group, block, winner_id, loser_id, data_id, format, moved FROM plan")
def merge_plan_prefix(spark: SparkSession, d: str) -> DataFrame:
    lib = parts(spark, d)
    return merge.numbered(merge.plan(lib["books"], lib["data"], merge.path_prefix())).select("merge_group", "block", "winner_id", "loser_id", "data_id", "format", "moved")


@query(f"WITH {_plan_sql(_PRE)} SELECT b.id, coalesce(CASE WHEN plan.moved THEN plan.winner_id END, b.id) AS book FROM b LEFT JOIN plan ON b.id = plan.data_id WHERE plan.data_id IS NULL OR plan.moved")
def merge_apply(spark: SparkSession, d: str) -> DataFrame:
    lib = parts(spark, d)
    return merge.apply(lib, merge.plan(lib["books"], lib["data"], merge.path_prefix()))["data"].select("id", "book")


@query(f"WITH {_plan_sql(_PRE)} SELECT data_id, CASE WHEN moved THEN 'quarantine_file' ELSE 'delete_file' END AS action FROM plan")
def merge_deletions(spark: SparkSession, d: str) -> DataFrame:
    lib = parts(spark, d)
    p = merge.plan(lib["books"], lib["data"], merge.path_prefix())
    return merge.merge_deletions(lib["data"], merge.apply(lib, p)["data"], p)


@query(
    f"""WITH {_plan_sql(_TA)} SELECT block, winner_id, loser_id, string_agg(DISTINCT format, ',' ORDER BY format) AS loser_formats,
    coalesce(string_agg(CASE WHEN moved THEN data_id::VARCHAR END, ',' ORDER BY data_id), '') AS moved_data_ids, coalesce(string_agg(CASE WHEN NOT moved THEN data_id::VARCHAR END, ',' ORDER BY data_id), '') AS duplicate_data_ids FROM plan GROUP BY ALL"""
)
def merge_report(spark: SparkSession, d: str) -> DataFrame:
    lib = parts(spark, d)
    return merge.report(merge.numbered(merge.plan(lib["books"], lib["data"], merge.title_author()), "TA")).drop("merge_group")


def _arrivals(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    s = table(spark, d, "scan_batches").select("batch", "book_id", "data_id", "title", "author", "ext", "bytes", "relative_path").distinct()
    return s.where("batch > '2024-06-30'").drop("batch"), s.where("batch <= '2024-06-30'").drop("batch")


_SK = lambda c: f"coalesce(lower({q.strip(c)}), 'none')"
_FK = f"{_SK('title')} || chr(1) || {_SK('ext')} || chr(1) || coalesce(bytes::VARCHAR, 'None')"
_BK = f"CASE WHEN {q.normalize('author')} = '' THEN {q.normalize('title')} ELSE {q.normalize('title')} || '|' || {q.normalize('author')} END"
_CASCADE = f"""a AS (SELECT DISTINCT batch, book_id, data_id, title, author, ext, bytes, relative_path, {_FK} AS fk, {_BK} AS bk, {q.normalize("title")} AS tk FROM scan_batches),
    s AS (SELECT * FROM a WHERE batch > '2024-06-30'), t AS (SELECT * FROM a WHERE batch <= '2024-06-30'),
    f AS (SELECT * FROM t QUALIFY row_number() OVER (PARTITION BY fk ORDER BY book_id DESC, data_id DESC) = 1),
    p AS (SELECT * FROM t WHERE relative_path IS NOT NULL QUALIFY row_number() OVER (PARTITION BY relative_path ORDER BY book_id, data_id) = 1),
    b AS (SELECT * FROM t QUALIFY row_number() OVER (PARTITION BY bk ORDER BY book_id, data_id) = 1),
    h AS (SELECT * FROM t QUALIFY row_number() OVER (PARTITION BY tk ORDER BY book_id, data_id) = 1),
    m AS (SELECT s.data_id, f.data_id AS fd, p.data_id AS pd, p.bytes IS DISTINCT FROM s.bytes AS other, b.data_id AS bd, h.data_id AS hd
      FROM s LEFT JOIN f ON s.fk = f.fk LEFT JOIN p ON s.relative_path = p.relative_path LEFT JOIN b ON s.bk = b.bk LEFT JOIN h ON s.tk = h.tk)"""


@query(
    f"""WITH {_CASCADE} SELECT data_id, CASE WHEN fd IS NOT NULL THEN 'file' WHEN pd IS NOT NULL AND other THEN 'path' WHEN bd IS NOT NULL THEN 'title_author' WHEN hd IS NOT NULL THEN 'title' ELSE 'none' END AS matched_by,
    CASE WHEN fd IS NOT NULL THEN fd WHEN pd IS NOT NULL AND other THEN pd WHEN bd IS NOT NULL THEN bd ELSE hd END AS target_data_id FROM m"""
)
def cascade_match(spark: SparkSession, d: str) -> DataFrame:
    return compare.cascade(*_arrivals(spark, d)).select("data_id", "matched_by", "target_data_id")


@query(f"WITH {_CASCADE} SELECT data_id, 'incremental' AS compare_side FROM m UNION ALL SELECT CASE WHEN fd IS NOT NULL THEN fd WHEN pd IS NOT NULL AND other THEN pd WHEN bd IS NOT NULL THEN bd ELSE hd END, 'full' FROM m WHERE coalesce(fd, CASE WHEN other THEN pd END, bd, hd) IS NOT NULL")
def side_expand(spark: SparkSession, d: str) -> DataFrame:
    c = compare.cascade(*_arrivals(spark, d)).select("data_id", "target_data_id")
    return compare.sides(c, ["data_id"], ["target_data_id"], "target_data_id").select("data_id", "compare_side")


def _split(c: Column) -> Column:
    return F.array_sort(F.array_distinct(F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ";"), lambda x: F.trim(x)), lambda x: x != "")))


def _by_type(c: Column) -> Column:
    """Packed identifiers as a map from type to value, several values of a type joined in order; an entry without a colon is a type without value."""
    pairs = F.transform(_split(c), lambda x: F.struct(F.trim(F.substring_index(x, ":", 1)).alias("k"), F.trim(F.regexp_replace(x, "^[^:]*:?", "")).alias("v")))
    keys = F.array_distinct(F.transform(pairs, lambda p: p["k"]))
    return F.map_from_arrays(keys, F.transform(keys, lambda k: F.array_join(F.array_sort(F.array_distinct(F.transform(F.filter(pairs, lambda p: p["k"] == k), lambda p: p["v"]))), "; ")))


FACETS = ("authors", "tags", "publisher", "languages", "rating", "series", "identifiers", "comments_len")


def _latest(spark: SparkSession, d: str) -> DataFrame:
    """The latest row of each sync_id and side as struct ``r``."""
    return table(spark, d, "scan_compare").groupBy("sync_id", "compare_side").agg(F.max_by(F.struct("data_id", *FACETS), F.struct("scanned_at", "data_id")).alias("r"))


def _publishers(spark: SparkSession, d: str, side: str) -> DataFrame:
    """One side's dictionary of publishers as they are written, under the least data_id that has them; a blank one is none."""
    p = _latest(spark, d).where(F.col("compare_side") == side).select("r.data_id", strip("r.publisher").alias("name")).where("name <> ''")
    return p.groupBy("name").agg(F.min("data_id").alias("id")).select("id", "name")


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    """The two copies of each book side by side, latest row each. Rating is a set of at most one, a comment of length 0 is missing."""
    last = _latest(spark, d)
    facets = {
        **{f: _split(F.col(f"r.{f}")) for f in ("authors", "tags", "languages")},
        "rating": F.filter(F.array(F.col("r.rating").cast("string")), lambda x: x.isNotNull()),
        **{f: F.col(f"r.{f}") for f in ("publisher", "series")},
        "identifiers": _by_type(F.col("r.identifiers")),
        "comments_len": F.nullif(F.col("r.comments_len"), F.lit(0)),
    }
    side = lambda n, p: last.where(F.col("compare_side") == n).select("sync_id", *[c.alias(f"{p}_{f}") for f, c in facets.items()])
    return side("incremental", "a").join(side("full", "b"), "sync_id")


_LIST = "list_sort(list_distinct(list_filter(list_transform(string_split(coalesce({0}, ''), ';'), lambda x: trim(x)), lambda x: x <> '')))"
_LAST = "SELECT * FROM scan_compare QUALIFY row_number() OVER (PARTITION BY sync_id, compare_side ORDER BY scanned_at DESC, data_id DESC) = 1"
_PAIRS = f"""r AS (SELECT sync_id, compare_side, {_LIST.format("authors")} AS au, {_LIST.format("tags")} AS tg, {_LIST.format("languages")} AS la,
      CASE WHEN rating IS NULL THEN [] ELSE [rating::VARCHAR] END AS ra, publisher, series, comments_len FROM ({_LAST})),
    p AS (SELECT x.sync_id, x.au AS a, y.au AS b, x.tg AS ta, y.tg AS tb, x.la AS la, y.la AS lb, x.ra AS ra, y.ra AS rb, trim(coalesce(x.publisher, '')) AS pa, trim(coalesce(y.publisher, '')) AS pb,
      trim(coalesce(x.series, '')) AS sa, trim(coalesce(y.series, '')) AS sb, coalesce(nullif(x.comments_len, 0)::VARCHAR, '') AS ca, coalesce(nullif(y.comments_len, 0)::VARCHAR, '') AS cb
      FROM r x JOIN r y ON x.sync_id = y.sync_id AND x.compare_side = 'incremental' AND y.compare_side = 'full')"""
#: Identifiers as rows: one per type and side, the values of a type joined in order.
_IDS = f"""e AS (SELECT sync_id, compare_side, unnest({_LIST.format("identifiers")}) AS x FROM ({_LAST})),
    i AS (SELECT sync_id, compare_side, trim(split_part(x, ':', 1)) AS k, string_agg(DISTINCT v, '; ' ORDER BY v) AS v FROM (SELECT *, trim(regexp_replace(x, '^[^:]*:?', '')) AS v FROM e) GROUP BY 1, 2, 3)"""
_ONLY = "array_to_string(list_filter({0}, lambda x: NOT list_contains({1}, x)), ', ')"


@query(
    f"""WITH {_PAIRS}, o AS (SELECT sync_id, a, b, {_ONLY.format("a", "b")} AS x, {_ONLY.format("b", "a")} AS y FROM p)
    SELECT sync_id, CASE WHEN len(a) = 0 AND len(b) = 0 THEN 'same(empty)' WHEN x = '' AND y = '' THEN 'same: ' || array_to_string(a, ', ')
    ELSE 'delta: ' || concat_ws('; ', CASE WHEN x <> '' THEN 'source_only=' || x END, CASE WHEN y <> '' THEN 'target_only=' || y END) END AS message FROM o"""
)
def set_compare(spark: SparkSession, d: str) -> DataFrame:
    p = _pairs(spark, d)
    return p.select("sync_id", compare.compare_sets(F.col("a_authors"), F.col("b_authors"))[1].alias("message"))


@query(
    f"""WITH {_PAIRS} SELECT sync_id, CASE WHEN pa = '' AND pb = '' THEN 'same(empty)' WHEN pb = '' THEN 'target_missing: ' || pa WHEN pa = '' THEN 'source_missing: ' || pb
    WHEN pa = pb THEN 'same: ' || pa ELSE 'conflict: source=' || pa || '; target=' || pb END AS message FROM p"""
)
def single_compare(spark: SparkSession, d: str) -> DataFrame:
    p = _pairs(spark, d)
    return p.select("sync_id", compare.compare_values(F.col("a_publisher"), F.col("b_publisher"))[1].alias("message"))


def _worst(sets: str, values: str) -> str:
    """Severity of facets by name: sets as columns of lists, values as columns of texts, on the two sides."""
    has = lambda x, y: f"len(list_filter({x}, lambda x: NOT list_contains({y}, x))) > 0"
    two = lambda names: [n.split("/") for n in names.split()]
    clash = " OR ".join(f"({x} <> {y} AND {x} <> '' AND {y} <> '')" for x, y in two(values))
    lacks = " OR ".join([f"({x} <> '' AND {y} = '')" for x, y in two(values)] + [has(x, y) for x, y in two(sets)])
    extra = " OR ".join([f"({y} <> '' AND {x} = '')" for x, y in two(values)] + [has(y, x) for x, y in two(sets)])
    return f"CASE WHEN {clash} THEN 3 WHEN {lacks} THEN 2 WHEN {extra} THEN 1 ELSE 0 END"


@query(
    f"""WITH {_PAIRS}, {_IDS}, m AS (SELECT coalesce(x.sync_id, y.sync_id) AS sync_id, max(CASE WHEN y.k IS NULL THEN 2 WHEN x.k IS NULL THEN 1 WHEN x.v <> y.v THEN 3 ELSE 0 END) AS s
      FROM (SELECT * FROM i WHERE compare_side = 'incremental') x FULL JOIN (SELECT * FROM i WHERE compare_side = 'full') y ON x.sync_id = y.sync_id AND x.k = y.k GROUP BY 1),
    w AS (SELECT p.sync_id, greatest({_worst("a/b ta/tb la/lb ra/rb", "pa/pb sa/sb ca/cb")}, coalesce(m.s, 0)) AS s FROM p LEFT JOIN m ON p.sync_id = m.sync_id)
    SELECT sync_id, CASE s WHEN 3 THEN 'conflict' WHEN 2 THEN 'target_missing' WHEN 1 THEN 'target_extra' ELSE 'same' END AS result FROM w"""
)
def metadata_rollup(spark: SparkSession, d: str) -> DataFrame:
    """All eight facets. Of comments the table holds lengths alone, so texts of equal length count as equal."""
    p = _pairs(spark, d)
    how = {"publisher": compare.compare_values, "series": compare.compare_values, "comments_len": compare.compare_values, "identifiers": compare.compare_maps}
    s = [how.get(f, compare.compare_sets)(F.col(f"a_{f}"), F.col(f"b_{f}"))[0] for f in FACETS]
    return p.select("sync_id", compare.rollup(s).alias("result"))


_PUBLISHERS = f"""n AS (SELECT compare_side AS side, {q.strip("publisher")} AS name, min(data_id) AS id FROM ({_LAST}) WHERE {q.strip("publisher")} <> '' GROUP BY 1, 2)"""


@query(
    f"""WITH {_PUBLISHERS}, f AS (SELECT side, lower(trim(name)) AS k, min(id) AS id, arg_min(name, id) AS name FROM n GROUP BY 1, 2),
    j AS (SELECT coalesce(s.k, t.k) AS dict_key, s.id AS source_id, t.id AS target_id, CASE WHEN t.k IS NULL THEN 'source_only' WHEN s.k IS NULL THEN 'target_only' WHEN s.name = t.name THEN 'same' ELSE 'conflict' END AS status
      FROM (SELECT * FROM f WHERE side = 'incremental') s FULL JOIN (SELECT * FROM f WHERE side = 'full') t ON s.k = t.k)
    SELECT *, CASE WHEN status = 'source_only' THEN 'insert' WHEN status = 'target_only' THEN 'keep_target' WHEN status = 'conflict' THEN 'merge_metadata' WHEN source_id = target_id THEN 'keep_target' ELSE 'relink_metadata' END AS action FROM j"""
)
def dict_full_outer(spark: SparkSession, d: str) -> DataFrame:
    return compare.diff_dictionary(_publishers(spark, d, "incremental"), _publishers(spark, d, "full"), "name")


@query(
    f"""WITH {_IDS}, c AS (SELECT sync_id, compare_side, lower(k) AS k, min(v) AS v FROM i GROUP BY 1, 2, 3)
    SELECT coalesce(s.sync_id, t.sync_id) AS source_book, coalesce(s.sync_id, t.sync_id) AS target_book, coalesce(s.k, t.k) AS child_key, s.v AS source_value, t.v AS target_value,
    CASE WHEN t.k IS NULL THEN 'source_only' WHEN s.k IS NULL THEN 'target_only' WHEN s.v = t.v THEN 'same' ELSE 'conflict' END AS status
    FROM (SELECT * FROM c WHERE compare_side = 'incremental') s FULL JOIN (SELECT * FROM c WHERE compare_side = 'full') t ON s.sync_id = t.sync_id AND s.k = t.k"""
)
def child_diff(spark: SparkSession, d: str) -> DataFrame:
    """Identifiers of the two sides of scan_compare as children of the copies that a sync_id ties; the values of a type are one value."""
    last = _latest(spark, d)
    side = lambda n: last.where(F.col("compare_side") == n).select(F.col("sync_id").alias("book"), F.explode(_by_type(F.col("r.identifiers"))).alias("type", "val"))
    books = last.select(F.col("sync_id").alias("source_book"), F.col("sync_id").alias("target_book")).distinct()
    return compare.diff_children(side("incremental"), side("full"), books, "type", "val")


def _suppliers(spark: SparkSession, d: str) -> Library:
    """Customers as books, nations as their authors, market segments as tags."""
    c = table(spark, d, "customer")
    seg = c.select("c_mktsegment").distinct().select(F.dense_rank().over(Window.orderBy("c_mktsegment")).cast("long").alias("id"), F.col("c_mktsegment").alias("name"))
    n = table(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("name"))
    return Library(
        {
            "books": c.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("title")),
            "authors": n,
            "books_authors_link": c.select(F.col("c_custkey").alias("id"), F.col("c_custkey").alias("book"), F.col("c_nationkey").cast("long").alias("author")),
            "tags": seg,
            "books_tags_link": c.join(seg, F.col("c_mktsegment") == F.col("name")).select(F.col("c_custkey").alias("id"), F.col("c_custkey").alias("book"), F.col("id").alias("tag")),
        }
    )


@query("SELECT c_custkey AS book, 'authors=' || n_name || ' | tags=' || c_mktsegment AS summary FROM customer JOIN nation ON c_nationkey = n_nationkey")
def profile_summary(spark: SparkSession, d: str) -> DataFrame:
    return compare.profiles(_suppliers(spark, d)).select("book", compare.profile_text(["authors", "tags"]).alias("summary"))


@query("SELECT c_custkey AS book, n_name AS author FROM customer JOIN nation ON c_nationkey = n_nationkey")
def primary_author(spark: SparkSession, d: str) -> DataFrame:
    return compare.primary_author(_suppliers(spark, d))


_FOLD = "translate(name, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(
    f"""WITH {_PUBLISHERS}, f AS (SELECT id, name FROM n WHERE side = 'full'), w AS (SELECT {_FOLD} AS k, min(name) AS name FROM n WHERE side = 'incremental' GROUP BY 1), x AS (SELECT * FROM w WHERE k NOT IN (SELECT {_FOLD} FROM f))
    SELECT id, name FROM f UNION ALL SELECT row_number() OVER (ORDER BY k) + (SELECT max(id) FROM f), name FROM x"""
)
def upsert_dictionary(spark: SparkSession, d: str) -> DataFrame:
    return upsert.upsert_dictionary(_publishers(spark, d, "full"), _publishers(spark, d, "incremental"), "name")[0]


@query(
    """WITH n AS (SELECT data_id AS id, book_id AS book, ext AS format, bytes AS size, file_basename AS name FROM book_files WHERE data_id IS NOT NULL AND book_id IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY data_id ORDER BY seen_at NULLS FIRST, batch NULLS FIRST, relative_path NULLS FIRST, title NULLS FIRST, book_id, ext NULLS FIRST, bytes NULLS FIRST, file_basename NULLS FIRST) = 1),
    h AS (SELECT book, upper(trim(coalesce(format, ''))) AS fm, arg_min(coalesce(uncompressed_size, -1), id) AS size, arg_min(coalesce(name, chr(1)), id) AS name FROM data_rows GROUP BY 1, 2)
    SELECT n.id AS source_id, CASE WHEN h.book IS NOT NULL THEN CASE WHEN h.size = coalesce(n.size, -1) AND h.name = coalesce(n.name, chr(1)) THEN 'already_synced' ELSE 'conflict' END
    WHEN row_number() OVER (PARTITION BY n.book, upper(trim(coalesce(n.format, ''))) ORDER BY n.id) > 1 THEN 'conflict' ELSE 'inserted' END AS status
    FROM n LEFT JOIN h ON n.book = h.book AND upper(trim(coalesce(n.format, ''))) = h.fm"""
)
def upsert_files(spark: SparkSession, d: str) -> DataFrame:
    """All files of book_files, first sighting each, into data_rows. A file without an id or a book has no place there."""
    seen = table(spark, d, "book_files").where("data_id is not null and book_id is not null").groupBy("data_id").agg(F.min(F.struct("seen_at", "batch", "relative_path", "title", "book_id", "ext", "bytes", "file_basename")).alias("f"))
    files = seen.select(F.col("data_id").alias("id"), F.col("f.book_id").alias("book"), F.col("f.ext").alias("format"), F.col("f.bytes").alias("uncompressed_size"), F.col("f.file_basename").alias("name"))
    return upsert.insert_files(table(spark, d, "data_rows").select("id", "book", "format", "uncompressed_size", "name"), files)[1]


@query(
    """WITH w AS (SELECT book_id AS id, min(title) AS v FROM book_files WHERE title IS NOT NULL AND book_id IS NOT NULL GROUP BY 1), k AS (SELECT b.id, coalesce(w.v, b.title) AS k, w.id IS NOT NULL AS want FROM books b LEFT JOIN w ON b.id = w.id),
    f AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY id) AS n FROM k WHERE want)
    SELECT id, CASE WHEN n > 1 OR EXISTS (SELECT 1 FROM books o WHERE o.title = f.k AND o.id <> f.id) THEN 'manual_confirming' ELSE 'updated' END AS status FROM f"""
)
def update_names(spark: SparkSession, d: str) -> DataFrame:
    """Each book takes the title that its files were seen with."""
    new = table(spark, d, "book_files").where("book_id is not null").select(F.col("book_id").alias("id"), F.col("title").alias("value"))
    return apply.update_names(table(spark, d, "books").select("id", "title"), new, "title", ["title"])[1]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(Q)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
