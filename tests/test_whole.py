"""Queries that take whole tables, against Python models of the reference and fixtures."""

import re

import pyarrow.parquet as pq

from shelfmark.plans import cleaning, linking

from .conftest import order, rows


def packed(v):
    return {x.strip() for x in (v or "").split(";")} - {""}


def by_type(v):
    out = {}
    for k, _, x in (e.partition(":") for e in packed(v)):
        out.setdefault(k.strip(), set()).add(x.strip())
    return out


def latest(data):
    rows = pq.read_table(f"{data}/scan_compare.parquet").to_pylist()
    out = {}
    for r in sorted(rows, key=lambda r: (r["scanned_at"], r["data_id"])):
        out[r["sync_id"], r["compare_side"]] = r
    return out


def rolled(a, b):
    """_metadata_compare_rollup over the eight facets, as a set of what each facet's text holds."""
    found = set()
    for f in ("authors", "tags", "languages", "rating"):
        x, y = ({str(r[f])} - {"None"} if f == "rating" else packed(r[f]) for r in (a, b))
        found |= ({"target_missing"} if x - y else set()) | ({"target_extra"} if y - x else set())
    for f in ("publisher", "series", "comments_len"):
        x, y = (str(r[f] or "").strip() for r in (a, b))
        found |= {"conflict"} if x and y and x != y else {"target_missing"} if x and not y else {"target_extra"} if y and not x else set()
    x, y = by_type(a["identifiers"]), by_type(b["identifiers"])
    for k in x.keys() | y.keys():
        found |= {"target_missing"} if k not in y else {"target_extra"} if k not in x else {"conflict"} if x[k] != y[k] else set()
    return next((s for s in ("conflict", "target_missing", "target_extra") if s in found), "same")


SCAN = "sync_id string, compare_side string, data_id long, scanned_at timestamp, authors string, tags string, publisher string, languages string, rating int, series string, identifiers string, comments_len long"


def scan(spark, path, pairs):
    """A scan_compare table of pairs of facets that differ from a common row."""
    base = dict(authors="A", tags="t", publisher="P", languages="zh", rating=8, series="S", identifiers="isbn:1; doi:10.1:2", comments_len=5)
    rows = [(n, side, i, None, *(base | change).values()) for n, two in pairs.items() for i, (side, change) in enumerate(zip(("incremental", "full"), two))]
    spark.createDataFrame(rows, SCAN).coalesce(1).write.parquet(f"{path}/scan_compare.parquet")
    return str(path)


def test_rollup_facets(spark, tmp_path):
    pairs = {
        "same": ({}, dict(identifiers=" doi:10.1:2;isbn:1;")), "languages": (dict(languages="zh;en"), {}), "rating": ({}, dict(rating=None)), "rating2": (dict(rating=None), {}), "rating3": ({}, dict(rating=6)),
        "series": ({}, dict(series="T")), "comments": ({}, dict(comments_len=6)), "comments2": ({}, dict(comments_len=0)), "comments3": (dict(comments_len=None), dict(comments_len=0)),
        "ids": ({}, dict(identifiers="isbn:1; doi:11.1:2")), "ids2": ({}, dict(identifiers="isbn:1")), "ids3": (dict(identifiers="isbn:1"), {}), "ids4": (dict(identifiers="isbn:1;isbn:2"), dict(identifiers="isbn:1; isbn:3")), "ids5": (dict(identifiers=None), dict(identifiers="")),
    }
    got = {r.sync_id: r.result for r in linking.metadata_rollup(spark, scan(spark, tmp_path, pairs)).collect()}
    assert got == {
        "same": "same", "languages": "target_missing", "rating": "target_missing", "rating2": "target_extra", "rating3": "target_missing", "series": "conflict", "comments": "conflict", "comments2": "target_missing",
        "comments3": "same", "ids": "conflict", "ids2": "target_missing", "ids3": "target_extra", "ids4": "conflict", "ids5": "same",
    }


def test_rollup_whole(spark, data):
    rows = latest(data)
    want = {i: rolled(rows[i, "incremental"], rows[i, "full"]) for i in {k[0] for k in rows} if (i, "incremental") in rows and (i, "full") in rows}
    assert {r.sync_id: r.result for r in linking.metadata_rollup(spark, data).collect()} == want


def test_path_parts_whole(spark, data, tmp_path):
    def parts(p):
        name = re.split(r"[/\\]", p or "")[-1].strip()
        m = re.fullmatch(r"(.+)\.([^.]+)", name, re.S)
        return (p, m and m[1].strip() or None, m and m[2].lower() or None)

    dirty = [None, "a/b\tc.PDF", "a/x.epub\t", "\n a\\y.txt\r\n", "a/　z .Mobi\x85", "tab\t", "d/.hidden", ""]
    spark.createDataFrame([(p,) for p in dirty], "init_path string").write.parquet(f"{tmp_path}/dedup_records.parquet")
    for where, paths in ((str(tmp_path), dirty), (data, pq.read_table(f"{data}/dedup_records.parquet")["init_path"].to_pylist())):
        assert rows(cleaning.path_parts(spark, where)) == order({parts(p) for p in paths})


def test_waterfall_restorable(spark, tmp_path):
    titles = {1: "中国历史地理".encode("gb18030").decode("latin-1"), 2: "中国历史", 3: "bad �", 4: None, 5: "Über café"}
    files = [(i, None, "2024-01", f"p/{i}", t, "xyz", i, i, f"n{i}", True) for i, t in titles.items()]
    spark.createDataFrame(files, "data_id long, seen_at timestamp, batch string, relative_path string, title string, ext string, bytes long, actual_bytes long, file_basename string, file_exists boolean").write.parquet(f"{tmp_path}/book_files.parquet")
    got = {r.data_id: r.reason_code for r in cleaning.rule_waterfall(spark, str(tmp_path)).collect()}
    assert got == {1: "title_mojibake", 2: "non_target_format", 3: "title_mojibake", 4: "non_target_format", 5: "non_target_format"}


def publishers(data, side):
    """name: least data_id, of the latest rows of a side."""
    out = {}
    for (_, s), r in latest(data).items():
        if s == side and (name := (r["publisher"] or "").strip()):
            out[name] = min(r["data_id"], out.get(name, r["data_id"]))
    return out


def test_child_diff_whole(spark, data, tmp_path):
    ids = {"a": ("isbn:1; isbn:2", "isbn:1; isbn:3"), "b": ("url:http://x", "URL:http://x; doi:2"), "c": ("doi:1", None), "d": ("x", "x")}
    scan(spark, tmp_path, {n: (dict(identifiers=x), dict(identifiers=y)) for n, (x, y) in ids.items()})
    status = lambda k, a, b: "source_only" if k not in b else "target_only" if k not in a else "same" if a[k] == b[k] else "conflict"
    for where in (str(tmp_path), data):
        sides = {"incremental": {}, "full": {}}
        for (i, s), r in latest(where).items():
            sides[s].update({(i, k.lower()): "; ".join(sorted(v)) for k, v in by_type(r["identifiers"]).items()})
        a, b = sides["incremental"], sides["full"]
        assert rows(linking.child_diff(spark, where)) == order((k[0], k[0], k[1], a.get(k), b.get(k), status(k, a, b)) for k in a.keys() | b.keys())


def test_dictionaries_whole(spark, data):
    a, b = publishers(data, "incremental"), publishers(data, "full")
    first = lambda p: {k: min((i, n) for n, i in p.items() if n.lower() == k) for k in {n.lower() for n in p}}
    s, t = first(a), first(b)
    got = {r.dict_key: (r.source_id, r.target_id, r.status) for r in linking.dict_full_outer(spark, data).collect()}
    status = lambda k: "source_only" if k not in t else "target_only" if k not in s else "same" if s[k][1] == t[k][1] else "conflict"
    assert got == {k: (s.get(k, (None,))[0], t.get(k, (None,))[0], status(k)) for k in s.keys() | t.keys()}
    fold = lambda n: "".join(c.lower() if c.isascii() else c for c in n)
    fresh = {}
    for n in a:
        if fold(n) not in {fold(m) for m in b}:
            fresh[fold(n)] = min(n, fresh.get(fold(n), n))
    new = [(max(b.values()) + i, fresh[k]) for i, k in enumerate(sorted(fresh, key=str.encode), 1)]
    assert rows(linking.upsert_dictionary(spark, data)) == order([(i, n) for n, i in b.items()] + new)


def test_upserts_whole(spark, duck, data):
    files = duck.sql("""WITH n AS (SELECT data_id AS id, book_id AS book, ext AS format, bytes AS size, file_basename AS name FROM book_files WHERE data_id IS NOT NULL AND book_id IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY data_id ORDER BY seen_at NULLS FIRST, batch NULLS FIRST, relative_path NULLS FIRST, title NULLS FIRST, book_id, ext NULLS FIRST, bytes NULLS FIRST, file_basename NULLS FIRST) = 1),
    h AS (SELECT book, upper(trim(coalesce(format, ''))) AS fm, arg_min(coalesce(uncompressed_size, -1), id) AS size, arg_min(coalesce(name, chr(1)), id) AS name FROM data_rows GROUP BY 1, 2)
    SELECT n.id, CASE WHEN h.book IS NOT NULL THEN CASE WHEN h.size = coalesce(n.size, -1) AND h.name = coalesce(n.name, chr(1)) THEN 'already_synced' ELSE 'conflict' END
    WHEN row_number() OVER (PARTITION BY n.book, upper(trim(coalesce(n.format, ''))) ORDER BY n.id) > 1 THEN 'conflict' ELSE 'inserted' END FROM n LEFT JOIN h ON n.book = h.book AND upper(trim(coalesce(n.format, ''))) = h.fm""")
    assert rows(linking.upsert_files(spark, data)) == order(files.fetchall())
    names = duck.sql("""WITH w AS (SELECT book_id AS id, min(title) AS v FROM book_files WHERE title IS NOT NULL GROUP BY 1), k AS (SELECT b.id, coalesce(w.v, b.title) AS k, w.id IS NOT NULL AS want FROM books b LEFT JOIN w ON b.id = w.id),
    f AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY id) AS n FROM k WHERE want)
    SELECT id, CASE WHEN n > 1 OR EXISTS (SELECT 1 FROM books o WHERE o.title = f.k AND o.id <> f.id) THEN 'manual_confirming' ELSE 'updated' END FROM f""")
    assert rows(linking.update_names(spark, data)) == order(names.fetchall())
