"""Reconciliation, orphans, merging, upserting, plans, files and streams on small fixtures."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmark.operators import anomaly, apply, checks, classify, compare, dedup, merge, reconcile, references, upsert
from shelfmark.sources import files
from shelfmark.sources.library import Library

from .conftest import order, rows


# --- reconciliation -------------------------------------------------------------------------------------------------


def test_field():
    rnd = random.Random(1)
    a, b = ([rnd.randrange(int(reconcile.P)) for _ in range(500)] for _ in "ab")
    assert reconcile.mul(np.array(a, np.uint64), np.array(b, np.uint64)).tolist() == [x * y % int(reconcile.P) for x, y in zip(a, b)]


@pytest.mark.parametrize("common,left,right", [(100, 0, 0), (100, 1, 0), (60, 3, 9), (0, 20, 20), (50, 40, 35), (0, 0, 7), (0, 0, 0)])
def test_bucket(common, left, right):
    rnd = np.random.default_rng(common + left)
    x = np.unique(rnd.integers(0, 1 << 60, common + left + right))
    a, b = x[: common + left], np.concatenate([x[:common], x[common + left :]])
    z = reconcile.points(4 * (left + right) + reconcile.FIRST_BOUND + reconcile.CONFIRM)
    fa, fb = (reconcile.characteristic(x, z).tolist() for x in (a, b))
    p, q, bound = reconcile.solve(len(a), fa, len(b), fb)
    of = lambda f, x: set(x[reconcile.roots(np.array([f] * len(x), np.uint64).reshape(len(x), -1), x.astype(np.uint64))].tolist()) if len(f) > 1 else set()
    assert of(p, a) == set(a.tolist()) - set(b.tolist()) and of(q, b) == set(b.tolist()) - set(a.tolist())
    assert bound <= 4 * (left + right) + reconcile.FIRST_BOUND
    if left + right > reconcile.FIRST_BOUND:
        assert reconcile.solve(len(a), fa[: left + right], len(b), fb[: left + right]) is None


def test_products():
    assert reconcile._products(np.arange(1, 8, dtype=np.uint64)[:, None], np.array([3, 1, 3])).ravel().tolist() == [6, 4, 210]


def test_recover(spark):
    rnd = random.Random(8)
    h = rnd.sample(range(1 << 60), 5000)
    # buckets with few, many and only differences, one larger than an Arrow batch
    cells = [(i % 40, l, x) for i, x in enumerate(h[:3000]) for l in (True, False) if rnd.random() < (0.9 if i % 40 < 5 else 0.999)] + [(40, False, x) for x in h[3000:3100]]
    cells += [(41, l, int(x)) for x in np.random.default_rng(1).choice(1 << 59, 25_000, replace=False) for l in (True, False) if not (l and x % 5000 == 0)]
    df = spark.createDataFrame(cells, "bucket long, l boolean, h long")
    sides = {l: {(b, x) for b, m, x in cells if m == l} for l in (True, False)}
    want = [(True, x) for _, x in sides[True] - sides[False]] + [(False, x) for _, x in sides[False] - sides[True]]
    assert rows(reconcile.recover(df, len(cells)).select("l", "h")) == order(want)


SCAN = "sync_id string, compare_side string, scanned_at timestamp, authors string, tags string, publisher string, identifiers string, k string, h string"


def test_differences(spark):
    t = lambda d: f"2024-01-{d:02d} 00:00:00"
    data = [
        ("a", "incremental", t(1), "X; Y", None, " P ", "i:1", "q", "q"),
        ("a", "full", t(2), " Y;X;;X", "", "P", "i:1;", "z", "z"),
        ("b", "incremental", t(1), "X", "t", None, None, None, None),
        ("c", "full", t(1), "X", "t", None, None, None, None),
        ("d", "incremental", t(1), "old", None, None, None, None, None),
        ("d", "incremental", t(3), "X", "t", None, None, None, None),
        ("d", "incremental", t(3), "X", "t", None, None, None, None),
        ("d", "full", t(2), "x", "t", "p", None, None, None),
        (None, "full", t(2), "x", None, None, None, None, None),
        ("e", "other", t(2), "x", None, None, None, None, None),
    ]
    df = spark.createDataFrame(data, "sync_id string, compare_side string, scanned_at string, authors string, tags string, publisher string, identifiers string, k string, h string").withColumn("scanned_at", F.col("scanned_at").cast("timestamp"))
    got = rows(reconcile.differences(df).select("sync_id", "difference"))
    assert got == order([("b", "full_missing"), ("c", "incremental_missing"), ("d", "authors"), ("d", "publisher"), (None, "incremental_missing")])
    assert reconcile.differences(df.limit(0)).count() == 0


def test_differences_hot_key(spark):
    df = spark.range(3000).select(F.when(F.col("id") < 1500, "hot").otherwise(F.col("id").cast("string")).alias("sync_id"), F.when(F.col("id") % 2 == 0, "full").otherwise("incremental").alias("compare_side"), F.timestamp_seconds("id").alias("scanned_at"), F.lit("x" * 5000).alias("authors"), F.lit(None).cast("string").alias("tags"), F.lit(None).cast("string").alias("publisher"), F.lit(None).cast("string").alias("identifiers"))
    got = reconcile.differences(df).groupBy("difference").count().collect()
    assert sorted(tuple(r) for r in got) == [("full_missing", 750), ("incremental_missing", 750)]


# --- orphans ---------------------------------------------------------------------------------------------------------


def brute_orphans(refs, parents):
    return order({(f, k, p) for k, p, t in refs for f in ["b"] if k is not None and t is not None and not any(i == k and (s is None or s <= t) and (e is None or t < e) for i, s, e in parents)})


def test_orphans(spark):
    rnd = random.Random(3)
    time = lambda: rnd.choice([None, *range(0, 100, 7)])
    parents = [(rnd.choice([None, *range(40)]), time(), time()) for _ in range(150)]
    refs = [(rnd.choice([None, 5, *range(60)]), rnd.choice(["p", "q", None]), time()) for _ in range(600)]
    p = spark.createDataFrame(parents, "id long, s long, e long").select("id", F.timestamp_seconds("s").alias("s"), F.timestamp_seconds("e").alias("e"), F.lit(1).alias("k"))
    r = spark.createDataFrame(refs, "b long, period string, t long").select("b", "period", F.timestamp_seconds("t").alias("t"), F.lit(0).alias("r"))
    want = brute_orphans(refs, parents)
    for size, batch in ((1 << 14, 1 << 16), (8, 10)):
        assert rows(references.orphans(r, {"b": (p, "id", "s", "e")}, "period", "t", size, batch).select("ref_field", "ref_id", "period")) == want
    assert references.orphans(r.limit(0), {"b": (p, "id", "s", "e")}, "period", "t").count() == 0
    assert references.orphans(r, {"b": (p.limit(0), "id", "s", "e")}, "period", "t").count() == len({(k, q) for k, q, t in refs if k is not None and t is not None})


# --- a small library -------------------------------------------------------------------------------------------------


def library(spark, shift=0):
    books = [(1, "Foo（a）", "Foo", "A", "A/Foo (1)"), (2, "foo(a)", "Foo", "a", "A/Foo (2)"), (3, "Bar 副本", "Bar", "B", "未知/Bar (3)"), (4, None, None, None, "x"), (5, "Bar", "Bar", "B", "未知/Bar (5)"), (6, "ÖÐ¹ú", "s", "C", "p (6)")]
    data = [(10, 1, "EPUB", 100, "n1"), (11, 2, "EPUB", 100, "n2"), (12, 2, "PDF", 5, "n2"), (13, 2, "pdf", 6, "n2"), (14, 3, "", None, "Unknown x"), (15, 5, "MOBI", 7, "n5"), (16, 99, "TXT", 1, "orphan"), (17, 6, "TXT", 9, "ÖÐ¹ú")]
    return Library(
        {
            "books": spark.createDataFrame(books, "id long, title string, sort string, author_sort string, path string"),
            "data": spark.createDataFrame(data, "id long, book long, format string, uncompressed_size long, name string"),
            "authors": spark.createDataFrame([(1, "Ann", "Ann"), (2, "Bob", "Bob"), (3, "ÖÐ¹ú", "x")], "id long, name string, sort string"),
            "books_authors_link": spark.createDataFrame([(1, 1, 1), (2, 1, 2), (3, 2, 2), (4, 3, 3), (5, 77, 1)], "id long, book long, author long"),
            "publishers": spark.createDataFrame([(1, "Pub", "Pub")], "id long, name string, sort string"),
            "books_publishers_link": spark.createDataFrame([(1, 1, 1)], "id long, book long, publisher long"),
            "comments": spark.createDataFrame([(1, 1, "good"), (2, 2, " ")], "id long, book long, text string"),
            "identifiers": spark.createDataFrame([(1, 1, "isbn", "1"), (2, 1, "doi", "2")], "id long, book long, type string, val string"),
            "custom_column_1": spark.createDataFrame([(1, "d\\Foo.epub"), (2, " d\\Foo.epub "), (3, "e\\Bar.pdf"), (4, "")], "id long, value string"),
            "books_custom_column_1_link": spark.createDataFrame([(1, 1, 1), (2, 1, 2), (3, 3, 3), (4, 3, 4)], "id long, book long, value long"),
        }
    )


def test_library_scan(spark, tmp_path):
    lib = library(spark)
    assert lib.usable and lib.children() == ["books_authors_link", "books_custom_column_1_link", "books_publishers_link", "comments", "data", "identifiers"]
    assert rows(lib.init_paths()) == [(1, "d\\Foo.epub"), (3, "e\\Bar.pdf")]
    got = {r.data_id: (r.relative_path, r.bytes, r.init_path) for r in lib.dedup_records().collect()}
    assert got[10] == ("A/Foo (1)/n1.epub", 100, "d\\Foo.epub") and got[14] == ("未知/Bar (3)/Unknown x", 0, "e\\Bar.pdf") and 16 not in got
    lib.save(str(tmp_path / "lib"))
    again = Library.load(spark, str(tmp_path / "lib"))
    assert again.counts() == lib.counts()


def test_integrity_and_delete(spark):
    lib = library(spark)
    assert dict(rows(checks.integrity(lib)))["orphan_data"] == 1 and dict(rows(checks.integrity(lib)))["empty_books"] == 1
    ids = spark.createDataFrame([(10,), (11,)], "id long")
    out = lib.delete(ids)
    assert sorted(r.id for r in out["books"].collect()) == [2, 3, 4, 5, 6]
    assert out["comments"].count() == 1 and out["identifiers"].count() == 0
    v = apply.verify(lib, out, ids)
    assert v["fully_executed"] == 1 and v["books_removed"] == 1
    assert apply.verify(out, out.delete(ids), ids)["removed"] == 0  # a second run changes nothing


def test_merge(spark):
    lib = library(spark)
    out, first, second = merge.merge(lib)
    # the two Foo books: 2 has most files and wins, the loser's format is there already; the unknown pair is merged by title only if titles agree
    assert rows(first.select("winner_id", "loser_id", "data_id", "moved")) == [(2, 1, 10, False)]
    assert second.count() == 0
    assert sorted(r.id for r in out["data"].collect()) == [11, 12, 13, 14, 15, 16, 17]
    assert rows(merge.merge_deletions(lib["data"], out["data"], first)) == [(10, "delete_file")]


def test_merge_conserves_files(spark):
    rnd = random.Random(5)
    books = spark.createDataFrame([(i, f"t{rnd.randrange(6)}", "a") for i in range(60)], "id long, title string, author_sort string")
    data = spark.createDataFrame([(i, rnd.randrange(60), rnd.choice(["A", "B", "C", "", None])) for i in range(200)], "id long, book long, format string")
    p = merge.plan(books, data, merge.title_author()).collect()
    # a sequential fold over the same data
    b, d = books.collect(), data.collect()
    n = {x.id: sum(y.book == x.id for y in d) for x in b}
    want = set()
    for t in {x.title for x in b}:
        ids_ = [x.id for x in b if x.title == t]
        if len(ids_) < 2:
            continue
        win = max(ids_, key=lambda i: (n[i], -i))
        have = {(y.format or "") for y in d if y.book == win}
        for lo in sorted(i for i in ids_ if i != win):
            for y in sorted((y for y in d if y.book == lo), key=lambda y: y.id):
                f = y.format or ""
                moved = bool(f) and f not in have
                have.add(f)
                want.add((win, lo, y.id, moved))
    assert {(r.winner_id, r.loser_id, r.data_id, r.moved) for r in p if r.data_id is not None} == want


def test_scan_and_handoffs(spark):
    lib = library(spark)
    hits = rows(anomaly.scan(lib).select("table", "column", "row_id", "reason"))
    assert hits == [("authors", "name", 3, "encoding_mojibake"), ("books", "title", 6, "encoding_mojibake"), ("data", "name", 17, "encoding_mojibake")]
    assert rows(anomaly.books_of(lib).where("table = 'authors' and row_id = 3").select("book_id")) == [(3,)]
    paths = lib["books_custom_column_1_link"].join(lib["custom_column_1"].withColumnRenamed("id", "v").withColumnRenamed("value", "path"), F.col("value") == F.col("v")).select("book", F.trim("path").alias("path")).where("path <> ''")
    assert rows(anomaly.title_handoffs(lib["books"], paths).select("id", "candidate", "status")) == [(3, "Bar", "update_file")]
    assert rows(anomaly.basename_handoffs(lib["data"].withColumnRenamed("format", "f"), paths).select("id", "candidate", "status")) == [(14, "Bar", "update_file")]


def test_clean_is_idempotent(spark, data):
    r = spark.read.parquet(f"{data}/dedup_records.parquet").select("book_id", "data_id", "title", "bytes", "init_path", F.lit("epub").alias("ext")).distinct()
    flags = dedup.clean(r)
    kept = r.join(flags.where("recommended_action = 'keep'").select("data_id"), "data_id", "left_semi")
    assert dedup.clean(kept).where("recommended_action <> 'keep'").count() == 0
    assert dedup.clean(r.limit(0)).count() == 0


def test_cascade(spark):
    cols = "book_id long, data_id long, title string, author string, ext string, bytes long, relative_path string"
    target = spark.createDataFrame([(1, 1, "T", "A", "epub", 5, "p1"), (2, 2, "t", "A", "EPUB", 5, "p2"), (3, 3, "U", "B", "pdf", 7, "p3"), (4, 4, None, None, None, None, None)], cols)
    source = spark.createDataFrame([(9, 1, " T ", "A", "epub", 5, "z"), (9, 2, "Q", "A", "txt", 5, "p3"), (9, 3, "u", "b", "mobi", 1, "z"), (9, 4, "T", "Z", "txt", 1, "z"), (9, 5, "new", None, None, None, None), (9, 6, None, None, None, None, None)], cols)
    assert rows(compare.cascade(source, target).select("data_id", "matched_by", "target_data_id")) == [(1, "file", 2), (2, "path", 3), (3, "title_author", 3), (4, "title", 1), (5, "none", None), (6, "file", 4)]


def test_compare_messages(spark):
    df = spark.createDataFrame([(["a", "b"], ["b", "c"], "x", " x ", {"i": "1", "j": "2"}, {"i": "1", "j": "3"}), ([], [], None, "y", None, None), (["a"], ["a"], "x", None, {"i": "1"}, {"i": "1"})], "a array<string>, b array<string>, x string, y string, m map<string,string>, n map<string,string>")
    got = df.select(compare.compare_sets(F.col("a"), F.col("b"))[1], compare.compare_values(F.col("x"), F.col("y"))[1], compare.compare_comments(F.col("x"), F.col("y"))[1], compare.compare_maps(F.col("m"), F.col("n"))[1], compare.rollup([compare.compare_sets(F.col("a"), F.col("b"))[0], compare.compare_maps(F.col("m"), F.col("n"))[0]])).collect()
    assert tuple(got[0]) == ("delta: source_only=a; target_only=c", "same: x", "same: len=1", "delta: i:same(1); j:conflict(source=2,target=3)", "conflict")
    assert tuple(got[1]) == ("same(empty)", "source_missing: y", "source_missing: target_len=1", "same(empty)", "same")
    assert tuple(got[2]) == ("same: a", "target_missing: x", "target_missing: source_len=1", "same: i:same(1)", "same")


@pytest.mark.parametrize("policy", ["fill-missing", "keep-target", "overwrite", "report-only"])
def test_upsert(spark, policy):
    full, inc = library(spark), library(spark)
    inc = inc.replace(comments=spark.createDataFrame([(1, 1, "better"), (2, 2, "filled"), (3, 6, "new")], "id long, book long, text string"))
    matches = spark.createDataFrame([(1, 10, 1), (2, 11, 2), (6, 17, None)], "book_id long, data_id long, target_book_id long")
    out, report = upsert.upsert(full, inc, matches, policy)
    assert sorted(r.id for r in out["books"].collect()) == [1, 2, 3, 4, 5, 6, 7]
    text = {r.book: r.text for r in out["comments"].collect()}
    assert text[7] == "new" and text[1] == ("better" if policy == "overwrite" else "good") and text[2].strip() == ("filled" if policy in ("fill-missing", "overwrite") else "")
    assert out["data"].where("book = 7").count() == 1 and out["authors"].count() == 3
    assert dict(rows(report.where("what = 'data'").groupBy("status").count())) == {"already_synced": 3, "conflict": 1, "inserted": 1}  # two PDFs of one book


def test_update_names(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, None)], "id long, name string")
    new = spark.createDataFrame([(1, "b"), (2, "z"), (3, "z"), (9, "q")], "id long, value string")
    out, st = apply.update_names(df, new, "name", ["name"])
    assert rows(st) == [(1, "manual_confirming"), (2, "updated"), (3, "manual_confirming")]
    assert rows(out) == [(1, "a"), (2, "z"), (3, "c"), (4, None)]


def test_plan_text(spark):
    p = spark.createDataFrame([(1, 10, "r", "delete_file", "", ""), (2, 11, "r", "update_metadata", "N'w", "")], "book_id long, data_id long, reason_code string, action string, new_title string, new_file_basename string")
    lines = apply.sql_lines(p, spark.createDataFrame([(1,)], "book_id long"), ["data", "comments"], "b")
    got = [r.line for r in lines.orderBy("seq").collect()]
    assert got[0] == "-- batch: b" and got[1] == "BEGIN TRANSACTION;" and got[-1] == "COMMIT;" and "UPDATE books SET title = 'N''w' WHERE id = 2;" in got and got[-2] == 'DELETE FROM "comments" WHERE book NOT IN (SELECT id FROM books);'
    assert rows(apply.parse_sql(lines)) == [("books", 1), ("data", 10)]
    b = spark.createDataFrame([(1, 1, "d&/a.pdf", True), (1, 2, "d&/b.pdf", True), (2, 3, "e/c.pdf", False)], "book_id long, data_id long, relative_path string, whole_book boolean")
    assert sorted(r.line for r in apply.bat_lines(b, "R", "Q").collect()) == ['move "R\\d^&" "Q"', 'move "R\\e\\c.pdf" "Q"']


def test_files(spark, tmp_path):
    df = spark.createDataFrame([(1, "a,\n\"b\""), (2, None)], "id long, v string")
    files.write_csv(df, str(tmp_path / "r"), ["id", "v", "w"], ["id"])
    assert rows(files.read_csv(spark, str(tmp_path / "r"), ["id", "v"]).na.fill("")) == [("1", 'a,\n"b"'), ("2", "")]
    assert files.read_csv(spark, str(tmp_path / "none"), ["id"]).count() == 0
    assert files.write_bom_csv(df, str(tmp_path / "b.csv"), ["id", "v"]) == 2
    assert (tmp_path / "b.csv").read_bytes().startswith(b"\xef\xbb\xbf")
    assert rows(files.read_csv(spark, str(tmp_path / "b.csv"), ["id"])) == [("1",), ("2",)]
    (tmp_path / "lib" / "x").mkdir(parents=True)
    (tmp_path / "lib" / "x" / "a.pdf").write_bytes(b"123")
    assert rows(files.listing(spark, str(tmp_path / "lib"))) == [("x/a.pdf", 3)]
    assert files.latest(["metadata-20240101.db", "metadata-20250101.x.db", "n.db"]) == "metadata-20250101.x.db"
    exp = spark.createDataFrame([(1, "x/a.pdf", "a"), (2, "x/b.pdf", "b"), (3, "y/c.pdf", "c")], "data_id long, relative_path string, title string")
    found = checks.find_files(exp, files.listing(spark, str(tmp_path / "lib")))
    assert dict(rows(found.select("data_id", "found_by"))) == {1: "exact", 2: "single_same_format", 3: "missing"}
    assert abs(checks.missing_share(found) - 1 / 3) < 1e-9


def test_decisions(spark):
    old = spark.createDataFrame([("a", "keep "), ("b", "")], "k string, human string")
    new = spark.createDataFrame([("a", None), ("b", "x"), ("c", None)], "k string, human string")
    assert rows(classify.carry_over(new, old, ["k"], ["human"])) == [("a", "keep "), ("b", "x"), ("c", None)]
    seq = spark.createDataFrame([("1", "x", 1), ("1", "y", 2), ("bad", "z", 3)], "id string, v string, seq int")
    assert rows(classify.last_by_key(seq, "id", "seq").select("id", "v")) == [(1, "y")]


def test_stream(spark, tmp_path, data):
    from shelfmark.streaming import arrivals

    src = spark.read.parquet(f"{data}/events.parquet")
    (tmp_path / "in").mkdir()
    src.union(src.limit(50)).repartition(3).write.mode("append").parquet(str(tmp_path / "in"))
    s = arrivals.first_arrivals(arrivals.arrivals(spark, str(tmp_path / "in"), src.schema), ["event_id"], "ts", "3650 days")
    q = arrivals.each_batch(s, lambda df, _: df.write.mode("append").parquet(str(tmp_path / "out")), str(tmp_path / "cp"))
    q.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == src.count()
    w = arrivals.windowed_counts(arrivals.arrivals(spark, str(tmp_path / "in"), src.schema), "ts", ["event_type"])
    q = w.writeStream.format("memory").queryName("counts").outputMode("complete").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp2")).start()
    q.awaitTermination()
    assert spark.table("counts").agg(F.sum("n")).first()[0] == src.count() + 50
