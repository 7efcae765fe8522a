import hashlib
import re
import uuid

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfmark.functions import codec, ids, text

SPACE = "\t\n\x0b\x0c\r\x1c\x1f \x85\xa0 　  "


def py_title(v):
    return re.sub(r"\s+", " ", v.strip().lower()).replace("（", "(").replace("）", ")")


def column(spark, values, f):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[1] for r in sorted(df.select("i", f(F.col("v"))).collect())]


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.text(alphabet="aBÉ中（）x1" + SPACE, max_size=12), min_size=50, max_size=200))
def test_normalize_title_equals_python(spark, values):
    assert column(spark, values, text.normalize_title) == [py_title(v) for v in values]


def test_golden(spark):
    assert column(spark, ["代理（卷一）  A　B ", None, "  Foo\tBAR (x) "], text.normalize_title) == ["代理(卷一) a b", "", "foo bar (x)"]
    paths = ["D:\\b\\书名.副本.epub", "a/b/c.pdf", ".epub", "noext", "trail.", "C:\\", "d\\x .txt ", None, "a\x85b.pdf"]
    assert column(spark, paths, text.path_stem) == ["书名.副本", "c", None, None, None, None, "x", None, "a\x85b"]
    assert column(spark, paths, text.path_suffix) == ["epub", "pdf", None, None, None, None, "txt", None, "pdf"]
    names = ["metadata-20260923.encoded.db", "metadata.merged.db", "metadata-full-20260713.db", None]
    assert column(spark, names, text.date_key) == ["2026-09-23", None, "2026-07-13", None]
    assert column(spark, ["100", "x", None, "7"], text.to_int) == [100, 0, 0, 7]
    assert column(spark, ["a&b%", "x", "a^b|<>", None], text.bat_quote) == ["a^&b%%", "x", "a^^b^|^<^>", ""]
    assert column(spark, ["it's", None], text.sql_quote) == ["'it''s'", "''"]
    assert column(spark, ["A ", None], text.sync_key) == ["a", "none"]


def test_ids(spark):
    df = spark.createDataFrame([("2026-09-23", 1, 2, "title_junk_keyword", "Thumbs", "file_duplicate", "9")], "b string, x int, y int, r string, m string, f string, n string")
    a, b = df.select(ids.stable_id("b", "x", "y", "r", "m"), ids.sync_id("b", "x", "y", "f", "n")).first()
    assert a == hashlib.sha1(b"2026-09-23|1|2|title_junk_keyword|Thumbs").hexdigest()[:16] == "32575207d89735df"
    assert b == uuid.uuid5(uuid.NAMESPACE_URL, "2026-09-23|1|2|file_duplicate|9").hex[:16] == "ca71c37dd8af5888"


def test_surrogates(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("v"))
    got = ids.with_surrogate(df, "n", ["v"], start=5).collect()
    assert all(r.n == r.v + 6 for r in got) and len(got) == 1000
    assert ids.with_surrogate(df.limit(0), "n", ["v"]).count() == 0


def test_codec(spark):
    v = ["Ã«Ôó¶«Ñ¡¼¯(µÚËÄ¾í)", "ÖÐ¹ú", "café", "Müller", "中国", "ひらがなÃ", "Ça", None, "", "a�"]
    got = column(spark, v, lambda c: codec.restore_text(c)["restored"])
    assert got[:6] == ["毛泽东选集(第四卷)", "中国", None, None, None, None] and len(got[6]) == 1 and got[7:] == [None, None, None]
    assert column(spark, ["ңԶ��", "plain", None], codec.partial_hint) == ["遥远◻◻", "", ""]
    assert column(spark, ["ÖÐ¹ú", "a�", "ok"], codec.is_mojibake) == [True, True, False]
