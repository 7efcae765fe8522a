"""Reports, typed readers, statuses and loaders on small fixtures."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from shelfmark.functions import codec, text
from shelfmark.functions.ids import random_id
from shelfmark.operators import anomaly, apply, checks, compare, courses, merge, reports
from shelfmark.rules import Layout, load_actions, load_targets
from shelfmark.schemas import BASENAME_REPAIR, CANDIDATE, ENCODE_REPAIR, MANUAL_REVIEW, TITLE_REPAIR
from shelfmark.sources import files
from shelfmark.sources.library import Library

from .conftest import rows

FILE = "batch string, book_id long, data_id long, title string, file_basename string, ext string, bytes long, relative_path string, custom_column_1_value string"


def test_manual_reviews(spark):
    garbled = "中国历史地理".encode("gb18030").decode("latin-1")
    data = [("b", 1, 1, garbled + " 副本", "x", "pdf", 1, "p", ""), ("b", 1, 2, "Tale 副本", "Unknown - y", "pdf", 1, "p", ""), ("b", 2, 3, "bad \ufffd", "z", "pdf", 1, "p", ""), ("b", 2, 4, "done 副本", "z", "pdf", 1, "p", ""), ("b", 3, 5, None, None, None, None, None, None), ("b", 1, 2, "Tale 副本", "Unknown - y", "pdf", 1, "p", "")]
    f = spark.createDataFrame(data, FILE).withColumn("_hit", F.lit(0))
    titles = spark.createDataFrame([(1, "update_file", "", "", "Tale"), (1, "update_file", "", "", "Tale")], "book_id long, status string, reason_code string, reason_detail string, candidate string")
    r = reports.manual_reviews(f, codec.is_mojibake("title"), titles, None, spark.createDataFrame([(4,)], "data_id long"))
    assert r.columns == MANUAL_REVIEW and len(r.columns) == 27
    got = {(x.data_id, x.reason_code): x for x in r.collect()}
    assert sorted(got) == [(1, "title_copy"), (2, "file_basename_unknown"), (2, "title_copy"), (3, "title_mojibake")]
    c = got[2, "title_copy"]
    assert (c.step2_repair_title_repair_status, c.step2_repair_title_candidate, c.step2_repair_basename_repair_status) == ("update_file", "Tale", "")
    u = got[2, "file_basename_unknown"]
    assert (u.matched_value, u.step2_repair_title_repair_status, u.step2_repair_basename_repair_status) == ("Unknown", "", "step2_repair_not_run")
    assert got[3, "title_mojibake"].partial_hint == "bad ◻" and c.partial_hint == "" and c.human_decision == ""
    assert reports.manual_reviews(f.limit(0), codec.is_mojibake("title")).count() == 0


def test_candidates(spark):
    f = spark.createDataFrame([("b", 1, 2, "Tale", "x", "pdf", 1, "p", ""), ("b", 1, 1, None, None, "ZIP", None, None, None), ("b", 1, 3, "T", "x", "pdf", 1, "p", "")], FILE)
    flagged = f.withColumn("reason_code", F.expr("case data_id when 1 then 'non_target_format' when 2 then 'title_junk_keyword' end")).withColumn("matched_value", F.lit("m")).withColumn("recommended_action", F.lit("delete_file"))
    r = reports.candidates(flagged).collect()
    assert r[0].asDict().keys() == dict.fromkeys(CANDIDATE).keys() and [(x.data_id, x.reason_code) for x in r] == [(1, "non_target_format"), (2, "title_junk_keyword")]
    assert r[1].candidate_id == hashlib.sha1(b"b|1|2|title_junk_keyword|m").hexdigest()[:16] and r[0].title == ""


def test_sizes_and_content(spark):
    assert [r[0] for r in spark.createDataFrame([(i, n) for i, n in enumerate([0, 1023, 1536, 5 << 20, 3 << 30, None])], "i int, n long").orderBy("i").select(text.human_size("n")).collect()][:5] == ["0B", "1023B", "1.5KB", "5.0MB", "3.0GB"]
    a = spark.createDataFrame([(1, "x"), (2, None)], "i int, v string")
    assert compare.same_content(a, a.select("v", "i").repartition(3)) and not compare.same_content(a, a.limit(1)) and not compare.same_content(a, a.select("i"))
    assert Library({}).get_or_empty(spark, "tags").columns == ["id", "name"]


def lib(spark, title, tags, size=5):
    one = lambda data, schema: spark.createDataFrame(data, schema)
    return Library(
        {
            "books": one([(1, title, title, "A", "p/x (1)"), (2, "Other", "Other", "B", "p/y (2)")], "id long, title string, sort string, author_sort string, path string"),
            "data": one([(10, 1, "PDF", size, "n"), (11, 2, "TXT", 7, "m")], "id long, book long, format string, uncompressed_size long, name string"),
            "authors": one([(1, "Ann", "Ann"), (2, "Bob", "Bob")], "id long, name string, sort string"), "books_authors_link": one([(2, 1, 1), (1, 1, 2), (3, 2, 1)], "id long, book long, author long"),
            "tags": one(list(enumerate(tags)), "id long, name string"), "books_tags_link": one([(i, 1, i) for i in range(len(tags))], "id long, book long, tag long"),
            "comments": one([(1, 1, "some text")], "id long, book long, text string"), "identifiers": one([(1, 1, "isbn", "9"), (2, 1, "doi", "4")], "id long, book long, type string, val string"),
        }
    )


def test_scan_rows(spark):
    inc, full = lib(spark, "Tale", ["t", "u"]), lib(spark, "Tale", ["t"])
    m = spark.createDataFrame([(1, 10, "file", 1, 10), (2, 11, "none", None, None)], "book_id long, data_id long, matched_by string, target_book_id long, target_data_id long")
    r = reports.scan_rows(m, inc, full, "b")
    assert len(r.columns) > 50 and r.columns[:3] == ["sync_id", "batch", "reason_code"]
    got = {x.source_data_id: x for x in r.collect()}
    a, b = got[10], got[11]
    assert (a.reason_code, a.recommended_action, a.tags_compare, a.metadata_compare) == ("file_duplicate_metadata_missing", "fill_missing_metadata", "delta: source_only=u", "target_missing")
    assert (a.source_author, a.source_authors, a.target_tags, a.source_comments_len, a.comments_compare) == ("Bob", "Ann; Bob", "t", "9", "same: len=9")
    assert a.source_identifiers == "doi:4; isbn:9" and json.loads(a.target_data_record)["uncompressed_size"] == 5 and a.source_relative_path == "p/x (1)/n.pdf"
    assert (b.reason_code, b.recommended_action, b.target_title, b.authors_compare) == ("new_book_or_file", "insert_book", None, "delta: source_only=Ann")
    assert len({x.sync_id for x in got.values()}) == 2


def test_book_maps(spark):
    m = spark.createDataFrame([(1, 1, 7), (1, 2, 8), (2, 3, 7), (3, 4, None), (4, 5, 9)], "book_id long, data_id long, target_book_id long")
    to, back = compare.book_maps(m)
    assert rows(to) == [(1, 7), (2, 7), (3, None), (4, 9)] and rows(back.select("target_book", "source_book")) == [(7, 1), (8, 1), (9, 4)]
    child = lambda d: spark.createDataFrame(d, "book long, type string, val string")
    d = compare.diff_children(child([(1, "isbn", "x"), (2, "isbn", "y"), (3, "isbn", "z")]), child([(7, "isbn", "x"), (9, "doi", "q"), (55, "isbn", "w")]), to, "type", "val")
    assert rows(d.select("source_book", "target_book", "child_key", "status")) == [(1, 7, "isbn", "same"), (2, 7, "isbn", "conflict"), (3, None, "isbn", "source_only"), (4, 9, "doi", "target_only"), (None, 55, "isbn", "target_only")]
    c = {(x.pair_key, x.compare_side): x.recommended_action for x in reports.child_rows(d, "identifiers").collect()}
    assert c["3:-:identifiers:isbn", "incremental"] == "insert" and c["-:55:identifiers:isbn", "full"] == "keep_target" and c["2:7:identifiers:isbn", "full"] == "merge_metadata"


def test_merge_statuses(spark):
    r = spark.createDataFrame([("a", "insert_book", "", True), ("b", "insert_book", "Keep_Target", True), ("c", "insert_book", None, False), ("d", "insert_data", "", False), ("e", "insert_data", "", False), ("f", "report_only", "", False)], "sync_id string, recommended_action string, human_decision string, manual boolean")
    done = spark.createDataFrame([("c", "inserted", "synced"), ("d", "conflict", "synced")], "sync_id string, data_status string, file_status string")
    got = {x.sync_id: (x.execute_status, x.verification_status) for x in reports.merge_statuses(r, done).collect()}
    assert got == {"a": ("manual_required", "not_verified"), "b": ("skipped", "not_applicable"), "c": ("success", "verified"), "d": ("failed", "not_verified"), "e": ("failed", "not_verified"), "f": ("skipped", "not_applicable")}
    assert {x.sync_id: x.execute_status for x in reports.merge_statuses(r, done, force=True).collect()}["a"] == "failed"
    u = spark.createDataFrame([(1, "inserted"), (1, "conflict"), (2, "already_synced"), (2, "filled_missing"), (3, "already_synced")], "source_book long, status string")
    assert rows(reports.metadata_status(u)) == [(1, "conflict", 1, 1), (2, "updated", 1, 0), (3, "already_synced", 0, 0)]


def test_readers(spark, tmp_path):
    write = lambda n, cols, data: (tmp_path / n).write_text("\ufeff" + "\n".join(",".join(r) for r in [cols, *data]), encoding="utf-8") and str(tmp_path / n)
    e = write("e.csv", ENCODE_REPAIR, [["books", "title", "5", "", "x", "delete_book(id=5) book_id=9", "", "delete_file"], ["tags", "name", "6", "", "x", "", "", "delete_file"], ["books", "title", "7", "8", "x", "", "", "keep"], ["books", "sort", "7", "8", "x", "", "", "delete_file"]])
    assert rows(files.read_encode_repairs(spark, e).select("row_id", "book_id")) == [(5, 9), (6, 6), (7, 8)]
    t = write("t.csv", TITLE_REPAIR, [["1", "a", "b", "update_file", "", "", ""], ["x", "a", "b", "", "", "", ""]])
    assert rows(files.read_title_repairs(spark, t).select("book_id", "candidate")) == [(1, "b")]
    b = write("b.csv", BASENAME_REPAIR, [["1", "2", "a", "PDF", "b", "update_file", "", "", ""]])
    assert rows(files.read_basename_repairs(spark, b).select("data_id", "candidate", "format")) == [(2, "b", "PDF")]
    assert files.read_title_repairs(spark, str(tmp_path / "none.csv")).count() == 0
    s = files.snapshot(files.read_title_repairs(spark, t), str(tmp_path / "s.json"), {"by_status": "status"})
    assert s == {"total": 1, "by_status": {"update_file": 1}} == json.loads((tmp_path / "s.json").read_text())
    with pytest.raises(FileNotFoundError):
        files.require(spark, {"scan": str(tmp_path / "none"), "t": t})
    assert files.first_existing(spark, [str(tmp_path / "none"), t]) == t
    r = spark.createDataFrame([("x", "1", 1), ("y", "2", 2), ("z", None, 3)], "reason_code string, v string, n int")
    files.write_by_reason(r, str(tmp_path / "by"), ["v", "n"], ["x", "z", "none"])
    assert rows(spark.read.csv(str(tmp_path / "by"), header=True).select("reason_code")) == [("x",), ("z",)]


def test_plans_for_people(spark):
    books = spark.createDataFrame([(1, "a", "x", "未知/t (1)"), (2, "a", "x", "未知/t (2)"), (3, "a", "x", "ann/t (3)"), (4, "a", "x", "ann/t (4)")], "id long, title string, author_sort string, path string")
    data = spark.createDataFrame([(1, 1, "PDF"), (2, 2, "PDF"), (3, 2, "TXT"), (4, 3, "PDF")], "id long, book long, format string")
    g = merge.review_groups(books, data)
    assert rows(g.select("merge_group", "winner_id", "loser_id", "data_id", "moved")) == [("U0001", 2, 1, 1, False)]
    plan = spark.createDataFrame([(1, 1, "d/a & b/x.pdf", "delete_file"), (1, 2, "d/a & b/y.pdf", "quarantine_file"), (2, 3, "top.pdf", "delete_file"), (3, 4, "k/z.pdf", "keep"), (4, 5, None, "delete_file")], "book_id long, data_id long, relative_path string, action string")
    lines = [r.line for r in apply.rollback_lines(plan, "L:", "Q:").orderBy("seq").collect()]
    assert lines == ["REM rollback book_id=1", 'if not exist "Q:\\d\\a ^& b" echo SKIP: "Q:\\d\\a ^& b"', 'if exist "Q:\\d\\a ^& b" move /Y "Q:\\d\\a ^& b" "L:\\d\\a ^& b"', "REM rollback book_id=2", 'if not exist "Q:\\." echo SKIP: "Q:\\."', 'if exist "Q:\\." move /Y "Q:\\." "L:\\."']
    hits = spark.createDataFrame([(0, "books", "title", 3, "bad", "encoding_mojibake", "good", "c"), (9, "tags", "name", 4, "bad", "bytes_lost", None, None)], "target int, table string, column string, row_id long, value string, reason string, restored string, chain string")
    r = reports.encode_report(hits, spark.createDataFrame([("books", 3, 3)], "table string, row_id long, book_id long"), anomaly.ids_by_book(data), spark.createDataFrame([(3, "p")], "book long, init_path string"))
    assert rows(r.select("serial", "book_id", "data_ids", "init_path")) == [(1, 3, "4", "p"), (2, None, "", "")]


def test_courses_and_checks(spark):
    c = spark.createDataFrame([("甲：乙",), ("甲",), ("甲：乙：丙",), (None,), (" ",), ("甲",)], "v string")
    assert rows(courses.dimension(c, "v")) == [(1, "甲", "甲", None), (2, "甲：乙", "甲", "乙"), (3, "甲：乙：丙", "甲", "乙：丙")]
    p = spark.createDataFrame([("a/b/c/d", "t"), ("a/b", "t"), ("x/b/c/d", "t"), ("a/b/c/d", "【完结】"), ("a/b/c/d\ufffd", "t"), (None, None)], "path string, title string")
    assert [r[0] for r in p.select(courses.rejected("path", "title", ("a",))).collect()] == [None, "shallow_path", "unknown_platform", "empty_title", "mojibake", "shallow_path"]
    listing = spark.createDataFrame([(f"d/f{i}.pdf",) for i in range(8)] + [("e/x.txt",)], "relative_path string")
    found = spark.createDataFrame([("d/gone.pdf", "missing"), ("z/gone.pdf", "missing"), ("e/x.txt", "exact")], "relative_path string, found_by string")
    assert rows(checks.diagnose(found, listing)) == [("d/gone.pdf", 8, [f"f{i}.pdf" for i in range(5)]), ("z/gone.pdf", 0, [])]
    expected = spark.createDataFrame([(1, "d/f1.pdf", "q"), (2, "d/other.pdf", "F3"), (3, "e/y.txt", "q"), (4, "d/none.pdf", "zz"), (5, "n/n.pdf", "q")], "data_id long, relative_path string, title string")
    assert rows(checks.find_files(expected, listing).select("data_id", "found_by")) == [(1, "exact"), (2, "name_match"), (3, "single_same_format"), (4, "ambiguous"), (5, "missing")]


def test_ordinary(spark):
    values = ["Plain 1", "中文《》", "é", "Ⅰ", "bad \ufffd", "\t", "★", "Ю", None, ""]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    assert [r[0] for r in df.orderBy("i").select(text.ordinary_only("v")).collect()] == [True, True, False, True, False, False, True, False, True, True]
    assert codec.hint("Ö\ufffd") == "脰◻" and codec.hint("ab\ufffd") == "ab◻"


def test_copy_plan_and_library(spark, tmp_path):
    f = lambda d: spark.createDataFrame(d, "relative_path string, actual_bytes long")
    got = apply.copy_plan(f([("a", 0), ("b", 0), ("c", 0), ("d", 0), ("", 0), (None, 0)]), f([("a", 1), ("b", 2), ("c", None)]), f([("a", 1), ("b", 3)]))
    assert rows(got) == [("a", 1, "already_synced"), ("b", 2, "copy"), ("c", None, "copy"), ("d", None, "file_missing")]
    new = lib(spark, "Tale", ["t"]).copy(str(tmp_path / "full"), spark)
    assert set(new) == set(lib(spark, "Tale", ["t"])) and new["data"].count() == 2
    assert rows(new.found_files(f([("p/x (1)/n.pdf", 4), ("p/x (1)/n.pdf", 6)]), "b").select("data_id", "file_exists", "actual_bytes")) == [(10, True, 6), (11, False, None)]


def test_library_diffs(spark):
    inc, full = lib(spark, "Tale", ["t", "U"]), lib(spark, "Tale", ["T", "v"])
    got = rows(compare.diff_dictionaries(inc, full).where("scope = 'tags'").select("dict_key", "status", "action"))
    assert got == [("t", "conflict", "merge_metadata"), ("u", "source_only", "insert"), ("v", "target_only", "keep_target")]
    assert rows(compare.diff_dictionaries(inc, full).where("scope = 'authors'").select("dict_key", "status")) == [("ann", "same"), ("bob", "same")]
    books = spark.createDataFrame([(1, 1), (2, None)], "source_book long, target_book long")
    changed = full.replace(identifiers=spark.createDataFrame([(1, 1, "isbn", "8"), (2, 2, "doi", "4")], "id long, book long, type string, val string"))
    assert rows(compare.diff_library_children(inc, changed, books).select("scope", "child_key", "status")) == [("comments", "comment", "same"), ("identifiers", "doi", "source_only"), ("identifiers", "doi", "target_only"), ("identifiers", "isbn", "conflict")]
    with pytest.raises(ValueError):
        compare.diff_dictionaries(Library({}), full)


def test_layout_and_config(spark, tmp_path):
    at = Layout("/data/", "b1")
    assert at.path(2, "x.csv") == "/data/b1/step-2/x.csv" and at.shown(at.path(2, "x.csv")) == "b1/step-2/x.csv"
    (tmp_path / "t.json").write_text('[{"table": "books", "column": "title", "label": "x"}]')
    (tmp_path / "a.json").write_text('{"noop": ["keep"], "clean": ["delete_file"]}')
    assert load_targets(str(tmp_path / "t.json")) == (("books", "title"),) and load_actions(str(tmp_path / "a.json"))["noop"] == ("keep",)
    p = spark.createDataFrame([("s1", "keep", 1, None, "update_file"), ("s2", "x", None, 2, None)], "sync_id string, action string, source_book_id long, target_book_id long, status string")
    assert [r.line for r in apply.note_lines(p).orderBy("seq").collect()] == ["-- sync_id=s1 action=keep source_book=1 target_book=-", "-- sync_id=s2 action=x source_book=- target_book=2"]
    assert [r.sync_id for r in apply.dry_run(p).collect()] == ["s2"]
    ids = spark.range(50).select(random_id().alias("i")).collect()
    assert len({r.i for r in ids}) == 50 and all(len(r.i) == 36 for r in ids)


def test_verify_books(spark):
    before = lib(spark, "Tale", ["t"])
    gone = spark.createDataFrame([(10,)], "id long")
    v = apply.verify(before, before.delete(gone), gone)
    assert (v["books_removed"], v["books_expected"], v["fully_executed"]) == (1, 1, 1)
    kept = before.delete(gone).replace(books=before["books"])
    assert apply.verify(before, kept, gone)["fully_executed"] == 0
