"""Queries p1, p2, p3, p5, p6, p8, p9 and p10 over the test tables, and the SQL that some of them can be checked with."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions.session import table
from shelfmark.llm import batches, forms, leaks, mojibake, packing, records, splitting, survivors


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return survivors.survivors(table(spark, d, "dedup_groups")).where("n_records > 1").select("group_key", "field", "data_id")


def p1_currency(spark: SparkSession, d: str) -> DataFrame:
    """All groups with the stamps of about a third of the rows taken away, so that learned precedence has to stand in for them."""
    lost = F.pmod(F.xxhash64("group_key", "data_id", "updated_at"), F.lit(3)) == 0
    rows = table(spark, d, "dedup_groups").withColumn("updated_at", F.when(~lost, F.col("updated_at")))
    return survivors.survivors(rows).where("n_records > 1").select("group_key", "field", "data_id")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return records.copies(table(spark, d, "dedup_records"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return forms.lookalike_pairs(table(spark, d, "dedup_records"), "data_id", "title")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """The oldest batch is history; the later ones arrive in one add, which checks them against it and each other."""
    t = table(spark, d, "scan_batches")
    first = t.agg(F.min("batch").alias("b")).first().b
    history = batches.PivotTable(spark)
    history.add(t.where(F.col("batch") == first))  # a single batch has no pair
    return history.add(t.where((F.col("batch") != first) | F.col("batch").isNull() | F.lit(first is None)))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    rec, rev = table(spark, d, "dedup_records"), table(spark, d, "manual_reviews")
    long = rec.select("data_id", F.explode(F.array(*[F.struct(F.lit(f"dedup_records.{f}").alias("f"), F.col(f).alias("v")) for f in ("title", "init_path")])).alias("x")).select("data_id", "x.f", "x.v")
    long = long.unionByName(rev.select("data_id", F.lit("manual_reviews.file_basename").alias("f"), F.col("file_basename").alias("v")))
    model = mojibake.learn(spark, long.where("v is not null").select("v"))
    found = mojibake.find_garbled(long.select(F.concat_ws(" ", "f", "data_id").alias("key"), "v"), "key", ["v"], model)
    at = F.split("key", " ")
    return found.select(F.split(at[0], r"\.")[0].alias("table_name"), F.split(at[0], r"\.")[1].alias("field"), at[1].cast("bigint").alias("data_id")).distinct()


def p8_containers(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack_documents(table(spark, d, "documents"), table(spark, d, "size_limits"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return leaks.find_leaks(table(spark, d, "documents"), table(spark, d, "eval_items")).select("doc_id", "item_id").distinct()


def p10_pieces(spark: SparkSession, d: str) -> DataFrame:
    return splitting.split_documents(table(spark, d, "documents"), table(spark, d, "size_limits"), with_text=True)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p1_found, p1_currency, p2_found, p3_found, p5_found, p6_found, p8_containers, p9_found, p10_pieces)}


#: Words that stand for no value, stated here anew so that the check does not lean on the operator's list.
_WORDS = ", ".join(f"'{w}'" for w in ("", "unknown", "untitled", "none", "null", "na", "nil", "notapplicable", "notavailable", "неизвестно", "безназвания", "нет", "unbekannt", "ohnetitel", "keine", "未知", "未知书名", "不详", "不明", "无题", "無題", "无", "無", "暂无", "无标题", "未命名", "なし", "不适用", "タイトルなし"))

P1 = f"""
WITH latest AS (
  SELECT * FROM dedup_groups WHERE group_key IS NOT NULL AND data_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY group_key, data_id ORDER BY updated_at DESC) = 1
), big AS (SELECT group_key FROM latest GROUP BY group_key HAVING count(*) > 1),
long AS (
  SELECT group_key, 'title' AS field, data_id, sort_key, updated_at FROM latest
  WHERE regexp_replace(lower(coalesce(title, '')), '[^\\p{{L}}\\p{{N}}]+', '', 'g') NOT IN ({_WORDS})
  UNION ALL SELECT group_key, 'init_path', data_id, sort_key, updated_at FROM latest
  WHERE regexp_replace(lower(coalesce(init_path, '')), '[^\\p{{L}}\\p{{N}}]+', '', 'g') NOT IN ({_WORDS})
  UNION ALL SELECT group_key, 'bytes', data_id, sort_key, updated_at FROM latest WHERE bytes > 0
)
SELECT group_key, field, data_id FROM long WHERE group_key IN (SELECT group_key FROM big)
QUALIFY row_number() OVER (PARTITION BY group_key, field ORDER BY sort_key NULLS LAST, updated_at DESC, data_id) = 1
"""


def _form_sql(column: str, letters: bool = True) -> str:
    """One form per look, from ranges and pairs stated here: what is invisible goes, blanks are blanks, other forms of a sign as NFKC has them, then the
    pairs. Without letters the pairs are left out, and what is composed stays composed."""
    q = lambda s: "'" + s.replace("'", "''") + "'"
    gone = r"[\x{ad}\x{34f}\x{61c}\x{115f}\x{1160}\x{180b}-\x{180e}\x{200b}-\x{200f}\x{202a}-\x{202e}\x{2060}-\x{206f}\x{3164}\x{fe00}-\x{fe0f}\x{feff}\x{ffa0}\x{e0001}-\x{e007f}\x{e0100}-\x{e01ef}]"
    forms = {c: unicodedata.normalize("NFKC", c) for a, b in ((0x2E80, 0x2FE0), (0x2160, 0x2180), (0xF900, 0xFB07), (0xFF01, 0xFFA0), (0xFFE0, 0xFFE7), (0x1D400, 0x1D800)) for c in map(chr, range(a, b))}
    forms |= dict.fromkeys("\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000", " ") | {"\u2010": "-", "\u2011": "-", "\xb5": "μ", "\u2126": "Ω", "\u212a": "K", "\u212b": "Å"}
    latin = dict(zip("АВЕКМНОРСТХУІЅЈԌԜԚҮһаеорсхуіѕјԁԛԝӏΑΒΕΖΗΙΚΜΝΟΡΤΥΧοιυνρϲϳаɑɡօ", "ABEKMHOPCTXYISJGWQYhaeopcxyisjdqwlABEZHIKMNOPTYXoiuvpcjaago")) | {"α": "a", "γ": "y"}
    latin |= {c: unicodedata.normalize("NFC", latin[d[0]] + d[1:]) for c in map(chr, range(0x370, 0x530)) if len(d := unicodedata.normalize("NFD", c)) > 1 and d[0] in latin}
    if not letters:
        latin = {}
    table = {k: "".join(latin.get(x, x) for x in v) for k, v in (forms | latin).items() if v != k}
    one, many = {k: v for k, v in table.items() if len(v) == 1}, {k: v for k, v in table.items() if len(v) > 1}
    x = f"translate(regexp_replace({column}, {q(gone)}, '', 'g'), {q(''.join(one))}, {q(''.join(one.values()))})"
    for k, v in many.items():
        x = f"replace({x}, {q(k)}, {q(v)})"
    return f"nfc_normalize({x})" if letters else x


def _letters_sql(x: str) -> str:
    return f"regexp_replace(replace(lower(upper({x})), 'ß', 'ss'), '[^\\p{{L}}\\p{{N}}]+', '', 'g')"


_PLAIN = _form_sql("coalesce({0}, '')", letters=False).replace("{", "{{").replace("}", "}}").replace("{{0}}", "{0}")

#: Two records are tied if the letters of one title are those of the other's parts, one after the other in some order; a search takes the letters apart from the left.
P2 = f"""
WITH RECURSIVE t AS MATERIALIZED (SELECT DISTINCT data_id AS k, {_PLAIN.format("title")} AS t, coalesce(bytes, 0) AS b, {_PLAIN.format("init_path")} AS p FROM dedup_records WHERE data_id IS NOT NULL),
n AS MATERIALIZED (SELECT DISTINCT k, b, {_letters_sql("t")} AS flat,
  list_filter(list_transform(string_split_regex(t, '[()\\[\\]{{}}（）［］【】〔〕:：|｜/／;；,，、\\t_]+|\\s+[-–—~]+\\s+|[-–—]+'), lambda x: {_letters_sql("x")}), lambda x: x <> '') AS parts,
  array_to_string(list_sort(list_filter(list_transform(string_split_regex(p, '[;；]'), lambda x: {_letters_sql("x")}), lambda x: x <> '')), ';') AS paths FROM t),
s AS MATERIALIZED (SELECT *, dense_rank() OVER (ORDER BY b, paths, array_to_string(list_sort(string_split(flat, '')), '')) AS root, dense_rank() OVER (ORDER BY b, paths, flat, parts) AS s FROM n),
u AS MATERIALIZED (SELECT DISTINCT root, s, flat, parts FROM s),
w AS (
  SELECT x.s AS i, y.s AS j, x.parts AS rest, y.flat AS text FROM u x JOIN u y ON x.root = y.root AND x.s <> y.s AND len(x.parts) > 1 AND x.flat <> y.flat
  UNION SELECT i, j, list_concat(list_slice(rest, 1, o - 1), list_slice(rest, o + 1, len(rest))), substr(text, length(rest[o]) + 1) FROM (SELECT *, unnest(range(1, len(rest) + 1)) AS o FROM w) WHERE starts_with(text, rest[o])
), e AS MATERIALIZED (
  SELECT DISTINCT i, j FROM w WHERE text = '' AND len(rest) = 0 UNION SELECT j, i FROM w WHERE text = '' AND len(rest) = 0 UNION SELECT x.s, y.s FROM u x JOIN u y ON x.root = y.root AND x.flat = y.flat AND x.s <> y.s
), c AS (SELECT s AS a, s AS z FROM u UNION SELECT c.a, e.j FROM c JOIN e ON c.z = e.i),
l AS (SELECT a AS s, min(z) AS label FROM c GROUP BY 1), m AS (SELECT DISTINCT s.k, l.label FROM s JOIN l ON s.s = l.s),
f AS (SELECT label, min(k) AS first_data_id FROM m GROUP BY 1)
SELECT DISTINCT first_data_id, k AS data_id FROM m JOIN f ON m.label = f.label WHERE k > first_data_id
"""

#: The edit distance of SQL counts bytes, so the characters of a pair are numbered first.
_SIGNS = "".join(map(chr, range(33, 127))).replace("'", "''")
P5 = f"""
WITH b AS (SELECT data_id AS k, batch, lower(coalesce(ext, '')) AS ext, bytes, unnest([{{'kind': 1, 'v': title}}, {{'kind': 2, 'v': regexp_replace(regexp_extract(coalesce(relative_path, ''), '([^/' || chr(92) || chr(92) || ']*)$', 1), '[.][^.]*$', '')}}]) AS x
  FROM scan_batches WHERE data_id IS NOT NULL AND bytes IS NOT NULL),
t AS (SELECT DISTINCT k, batch, ext, bytes, x.kind AS kind, {_letters_sql(_PLAIN.format("x.v"))} AS v FROM b),
n AS MATERIALIZED (SELECT *, regexp_replace(v, '[^\\p{{Nd}}〇零一二三四五六七八九十百千万亿两]', '', 'g') AS nums FROM t WHERE v <> ''),
p AS (SELECT x.k AS a, y.k AS c, x.v AS v, y.v AS w, array_to_string(list_distinct(string_split(x.v || y.v, '')), '') AS signs FROM n x JOIN n y ON x.kind = y.kind AND x.ext = y.ext AND x.nums = y.nums AND x.k < y.k AND x.batch IS DISTINCT FROM y.batch
  AND abs(x.bytes - y.bytes) <= 0.005 * greatest(abs(x.bytes), abs(y.bytes)) AND abs(length(x.v) - length(y.v)) <= 2)
SELECT DISTINCT a AS data_id_a, c AS data_id_b FROM p WHERE v = w OR levenshtein(translate(v, signs, substr('{_SIGNS}', 1, length(signs))), translate(w, signs, substr('{_SIGNS}', 1, length(signs)))) <= 2
"""


P3 = f"""
WITH v AS (SELECT DISTINCT title, {_form_sql("title")} AS form FROM dedup_records WHERE title IS NOT NULL),
many AS (SELECT form FROM v GROUP BY form HAVING count(*) > 1),
m AS (SELECT DISTINCT r.data_id, v.title, v.form FROM dedup_records r JOIN v ON r.title = v.title JOIN many ON v.form = many.form)
SELECT DISTINCT a.data_id AS data_id_a, b.data_id AS data_id_b
FROM m a JOIN m b ON a.form = b.form AND a.title <> b.title AND a.data_id < b.data_id
"""


def oracle_sql() -> dict[str, str]:
    return {"p1_found": P1, "p2_found": P2, "p3_found": P3, "p5_found": P5}
