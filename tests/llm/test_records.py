import itertools
import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from shelfmark.llm import batches, forms, records, survivors

from ..conftest import order, rows


def letters(t):
    return "".join(c for c in forms.canonical(t or "").upper().lower() if unicodedata.category(c)[0] in "LN")


# --- problem 2 -------------------------------------------------------------------------------------------------------


def parts(t):
    return [p for p in map(letters, re.split(r"[()\[\]{}（）［］【】〔〕:：|｜/／;；,，、\t_]+|\s+[-–—~]+\s+|[-–—]+", t or "")) if p]


def brute_copies(data):
    data = sorted({(k, t, b or 0, tuple(sorted(x for x in map(letters, re.split("[;；]", p or "")) if x))) for k, t, b, p in data if k is not None})
    group = list(range(len(data)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    def ways(t):
        return {letters(t)} | {"".join(x) for x in itertools.permutations(parts(t))}

    for i, j in itertools.combinations(range(len(data)), 2):
        if data[i][2:] == data[j][2:] and (data[i][0] == data[j][0] and letters(data[i][1]) == letters(data[j][1]) or ways(data[i][1]) & ways(data[j][1])):
            group[find(j)] = find(i)
    out = set()
    for c in {find(i) for i in range(len(data))}:
        ks = sorted({data[i][0] for i in range(len(data)) if find(i) == c})
        out |= {(ks[0], k) for k in ks[1:]}
    return sorted(out)


FIXTURE = [
    (1, "The Old Mill (Vol. 2)", 10, "D:\\a\\x.pdf; /srv/b y.pdf"),
    (2, "Vol. 2 - THE OLD MILL", 10, "/srv/b y.pdf;d:/A/X.PDF"),
    (3, "theoldmillvol2", 10, '"D:\\a\\x.pdf" ; //srv/by.pdf'),
    (4, "The Old Mills (Vol. 2)", 10, "D:\\a\\x.pdf; /srv/b y.pdf"),
    (5, "The Old Mill (Vol. 2)", 11, "D:\\a\\x.pdf; /srv/b y.pdf"),
    (6, "The Old Mill (Vol. 2)", 10, "D:\\a\\x.pdf; /srv/b y.pdf; c"),
    (7, None, None, None), (8, "", 0, ""), (9, " . ", None, ";"),
    (10, "磨坊之山谷 (卷一)", 5, None), (11, "卷一\t磨坊之山谷", 5, ""), (12, "山谷之磨坊 (卷一)", 5, ""),
    (13, "Straße", 1, "p"), (14, "STRASSE", 1, "P"), (15, "A, B, C", 2, None), (16, "C: A (B)", 2, None), (17, "cab", 2, None), (18, "A B C D - E / F | G", 3, None), (19, "G (E) F: A B C D", 3, None),
    (20, "x" * 100_000, 1, None), (21, "X " * 100_000, 1, None), (1, "The Old Mill (Vol. 2)", 10, "D:\\a\\x.pdf; /srv/b y.pdf"), (None, "The Old Mill (Vol. 2)", 10, None),
]


def frame(spark, data):
    return spark.createDataFrame(data, "data_id long, title string, bytes long, init_path string").withColumn("k", F.lit(1)).withColumn("way", F.lit("z")).withColumn("_root", F.lit(0))


def test_copies(spark):
    df = frame(spark, FIXTURE)
    assert rows(records.copies(df)) == sorted([(1, 2), (1, 3), (7, 8), (7, 9), (10, 11), (13, 14), (15, 16), (15, 17), (18, 19), (20, 21)])
    assert brute_copies([r for r in FIXTURE if len(r[1] or "") < 1000]) == sorted([(1, 2), (1, 3), (7, 8), (7, 9), (10, 11), (13, 14), (15, 16), (15, 17), (18, 19)])
    assert records.copies(df.limit(0)).count() == 0
    c = {r.data_id: r.n_copies for r in records.collapse(df).where("data_id is not null").collect()}
    assert c == {1: 3, 4: 1, 5: 1, 6: 1, 7: 3, 10: 2, 12: 1, 13: 2, 15: 3, 18: 2, 20: 2}


def test_copies_equal_brute_force(spark, data):
    d = spark.read.parquet(f"{data}/dedup_records.parquet")
    sample = [tuple(r) for r in d.select("data_id", "title", "bytes", "init_path").distinct().collect()]
    rnd = random.Random(2)
    more = [(100_000 + i, rnd.choice([str.upper, str.lower, lambda t: t.replace(" ", ""), lambda t: " ".join(reversed(t.split(" (")))])(t), b, p) for i, (_, t, b, p) in enumerate(rnd.sample([s for s in sample if s[1]], 60))]
    both = sample + more
    # compare within blocks of equal letters only, for speed
    block = {}
    for r in both:
        block.setdefault("".join(sorted(letters(r[1]))), []).append(r)
    want = sorted(x for g in block.values() for x in brute_copies(g))
    assert rows(records.copies(frame(spark, both))) == want


@pytest.mark.parametrize(
    "titles",
    [
        ["A | B | C | D", "B A D C", "C-D-A-B"], ["A | B | C | D | E", "B A C E D"], ["A: BCD", "B: CDA", "C: DAB"], ["one/two/three/four/five/six", "six five four three two one", "sixfive (fourthree): twoone"],
        ["aa|a|aaa|aa|aaaa", "aaaaaaaaaaaa"], ["|".join(f"p{i}" for i in range(40)), " ".join(f"p{i}" for i in reversed(range(40)))], ["ab: cd", "abc: d", "cdab"],
    ],
)
def test_any_number_of_parts(spark, titles):
    df = frame(spark, [(i, t, 7, "p") for i, t in enumerate(titles)] + [(99, titles[0][:-1] + "zz", 7, "p")])
    assert rows(records.copies(df)) == [(0, i) for i in range(1, len(titles))]


def test_reorder():
    rnd = random.Random(5)
    cut_at = lambda t, k: [x for x in ("".join(t[i:j]) for i, j in itertools.pairwise([0, *sorted(rnd.sample(range(len(t) + 1), k)), len(t)])) if x]
    for _ in range(300):
        t = [rnd.choice("ab") for _ in range(rnd.randrange(1, 9))]
        a = cut_at(t, min(3, len(t)))
        b = cut_at(rnd.sample(t, len(t)), min(2, len(t)))
        every = lambda p: {"".join(x) for x in itertools.permutations(p)}
        assert records.reorder(a, b) == bool(every(a) & every(b))


def test_hot_class(spark):
    df = spark.range(20_000).select(F.col("id").alias("data_id"), F.when(F.col("id") % 3 == 0, F.lit("Hot  Title")).otherwise(F.concat(F.lit("t"), F.col("id").cast("string"))).alias("title"), F.lit(None).cast("long").alias("bytes"), F.lit(None).cast("string").alias("init_path"))
    assert records.copies(df).count() == 20_000 // 3


# --- problem 3 -------------------------------------------------------------------------------------------------------


def test_lookalikes(spark):
    v = ["Old Mill", "Оld Mill", "Ｏｌｄ　Ｍｉｌｌ", "Old\u00a0Mi\u200bll", "old mill", "Old  Mill", "Old Mill.", "café", "cafe\u0301", "cafe", "⽕", "火", "曰记", "日记", "", "\u200b", None, "ﬁn", "fin", "Old Mill"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(v)], "data_id long, title string").withColumn("value", F.lit(0)).withColumn("form", F.lit(""))
    same = [{0, 1, 2, 3, 19}, {7, 8}, {10, 11}, {14, 15}, {17, 18}]
    want = sorted((a, b) for g in same for a, b in itertools.combinations(sorted(g), 2) if v[a] != v[b])
    assert rows(forms.lookalike_pairs(df, "data_id", "title")) == want
    c = {r.data_id: r.canonical for r in forms.canonicalize(df, "title").collect()}
    assert {c[i] for i in (0, 1, 2, 3, 19)} == {"Old Mill"} and c[16] is None and c[4] == "old mill" and c[10] == "火"
    assert forms.lookalike_pairs(df.limit(0), "data_id", "title").count() == 0


def test_skeleton_equals_python(spark, data):
    t = spark.read.parquet(f"{data}/dedup_records.parquet").select("title").distinct().where("title is not null")
    for letters_ in (True, False):
        got = t.select("title", forms.skeleton("title", letters=letters_)).collect()
        assert all(unicodedata.normalize("NFC", b) == forms.canonical(a, letters=letters_) for a, b in got)


# --- problem 5 -------------------------------------------------------------------------------------------------------


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


def agree(a, b):
    a, b = letters(a), letters(b)
    nums = lambda t: [c for c in t if c.isdecimal() or c in batches.NUMERALS]
    return bool(a and b) and nums(a) == nums(b) and distance(a, b) <= 2


def brute_batches(data):
    stem = lambda p: re.sub(r"\.[^.]*$", "", re.split(r"[/\\]", p or "")[-1])
    out = set()
    for x, y in itertools.combinations(sorted(set(data), key=repr), 2):
        if x[1] != y[1] and x[0] != y[0] and None not in (x[3], y[3], x[0], y[0]) and (x[2] or "").lower() == (y[2] or "").lower() and abs(x[3] - y[3]) <= 0.005 * max(abs(x[3]), abs(y[3])) and (agree(x[4], y[4]) or agree(stem(x[5]), stem(y[5]))):
            out.add((min(x[0], y[0]), max(x[0], y[0])))
    return sorted(out)


def test_batches_equal_brute_force(spark):
    rnd = random.Random(7)
    base = ["山谷之灯塔 卷一", "The Quiet Mill 12", "Тихий мост", "ab", ""]
    data = []
    for i in range(260):
        t = list(rnd.choice(base))
        for _ in range(rnd.randrange(4)):
            at = rnd.randrange(len(t) + 1)
            t[at : at + rnd.randrange(2)] = rnd.choice(["", "x", "1", "三", " ", "é"])
        size = rnd.choice([None, 0, -5, 1000, 1004, 1005, 1006, 995, 200_000, 201_000, 200_999])
        data.append((rnd.choice([None, *range(200)]), rnd.choice(["b1", "b2", None]), rnd.choice(["pdf", "PDF", "epub", None]), size, rnd.choice(["".join(t), None]), rnd.choice([None, "a/b/" + "".join(t) + ".pdf", "未知/x"])))
    df = spark.createDataFrame(data, "data_id long, batch string, ext string, bytes long, title string, relative_path string").withColumn("k", F.lit(0)).withColumn("sig", F.lit(0))
    assert rows(batches.check_batch(df)) == brute_batches(data)
    assert batches.check_batch(df.limit(0)).count() == 0 == batches.check_batch(df.limit(0), df).count()


def test_pivot_table(spark, tmp_path, data):
    df = spark.read.parquet(f"{data}/scan_batches.parquet")
    want = rows(batches.check_batch(df))
    table, got = batches.PivotTable(spark, str(tmp_path / "pivots")), set()
    for lo, hi in (("", "2024-01-14"), ("2024-01-14", "2024-06-30"), ("2024-06-30", "9")):
        part = df.where((F.col("batch") > lo) & (F.col("batch") <= hi))
        result = table.add(part)
        got |= set(rows(result))
    assert sorted(got) == want == sorted({tuple(r) for r in brute_batches([tuple(r) for r in df.select("data_id", "batch", "ext", "bytes", "title", "relative_path").collect()])})
    assert table.adds() == [1, 2, 3] and rows(table.check(2)) and set(rows(table.check(3))) == set(rows(result))
    # one size reads one or two zones of history
    new, history = table._read("sigs", [3]), table._read("sigs", [1, 2]).where(F.col("zone").isin([7, 8]))
    plan = batches.agreeing(new.where("bytes = 1000"), history)._jdf.queryExecution().toString()
    assert re.search(r"PartitionFilters: \[[^]]*zone", plan)
    assert re.search(r"zone=\d", " ".join(str(p) for p in (tmp_path / "pivots" / "sigs" / "add=1").iterdir()))


# --- problem 1 -------------------------------------------------------------------------------------------------------


def ts(n):
    return None if n is None else f"2024-01-01 00:00:{n:02d}"


def groups(spark, data):
    return spark.createDataFrame([(g, k, t, b, p, s, ts(u)) for g, k, t, b, p, s, u in data], "group_key string, data_id long, title string, bytes long, init_path string, sort_key int, updated_at string").withColumn("updated_at", F.col("updated_at").cast("timestamp")).withColumn("k", F.lit(0)).withColumn("field", F.lit(""))


def test_survivors(spark):
    data = [
        ("g", 1, "Unknown", 0, "p1", 0, 1), ("g", 2, "T2", 5, None, 1, 2), ("g", 3, "T3", 6, "p3", 1, 3), ("g", 4, "T4", 7, "p4", None, 9),
        ("g", 2, "", -1, "n/a", 1, 4),  # the later row of record 2
        ("h", 5, "only", 1, "p", 0, 1), ("i", 6, "--", None, "(null)", 0, 1), ("i", 7, "无题", 0, " ", 0, 1),
        ("j", 8, "a", 1, "p", None, 5), ("j", 9, "b", 1, "p", None, 5), (None, 10, "x", 1, "p", 0, 1),
    ]
    got = {(r.group_key, r.field): (r.data_id, r.value) for r in survivors.survivors(groups(spark, data)).where("n_records > 1").collect()}
    assert got == {("g", "title"): (3, "T3"), ("g", "bytes"): (3, "6"), ("g", "init_path"): (1, "p1"), ("j", "title"): (8, "a"), ("j", "bytes"): (8, "1"), ("j", "init_path"): (8, "p")}
    assert survivors.survivors(groups(spark, data).limit(0)).count() == 0


def test_currency_without_stamps(spark):
    # thirty records whose title gains a bracket over time teach that bracketed titles are newer
    data = [(f"t{i}", 100 + i, "Plain title", 1, "p", 0, 1) for i in range(30)] + [(f"t{i}", 100 + i, "Plain title (Vol. 1)", 1, "p", 0, 2) for i in range(30)]
    data += [("u", 1, "Some title", 1, "p", 0, None), ("u", 2, "Some title (Vol. 3)", 1, "p", 0, None)]
    data += [("v", 3, "Other title", 1, "p", 0, 7), ("v", 4, "Other title (Vol. 3)", 1, "p", 0, None)]
    data += [("w", 5, "Same", 1, "p", 0, 3), ("w", 6, "Else", 1, "p", 0, 4), ("w", 7, "Else", 1, "p", 0, None), ("w", 8, "Same", 1, "p", 0, None)]
    got = {(r.group_key): r.data_id for r in survivors.survivors(groups(spark, data)).where("n_records > 1 and field = 'title'").collect()}
    assert got["u"] == 2 and got["v"] == 4 and got["w"] == 6


def mask(field, v):
    if field == "bytes":
        return (1 << (v.bit_length() - 1)) - 1
    v = v.strip()
    return sum(bool(re.search(rx.replace("\\p{Lu}", "[A-Z]").replace("\\p{Nd}", "[0-9]"), v)) << i for i, rx in enumerate(survivors.TRAITS))


def brute_survivors(data, learned):
    """One value per group and field, by comparing all its records with each other."""
    fields, out = ("title", "bytes", "init_path"), set()
    place = lambda f, v: mask(f, v) & learned[f][0] | ~mask(f, v) & learned[f][1]
    for g in {r[0] for r in data}:
        for i, f in enumerate(fields):
            have = [(k, s, ts, v) for _, k, *vs, s, ts in (r for r in data if r[0] == g) if (v := vs[i]) and v != "Unknown"]
            if not have:
                continue
            lead = min((s is None, s or 0) for _, s, _, _ in have)
            have = [(k, ts if ts is not None else max((t for _, s2, t, w in have if w == v and t is not None and (s2 is None, s2 or 0) == lead), default=None), place(f, v)) for k, s, ts, v in have if (s is None, s or 0) == lead]
            stamped = sorted((-t, k, o) for k, t, o in have if t is not None)
            free = [o for _, t, o in have if t is None]
            above = lambda a, b: a & b == a and a != b
            best = []
            for k, t, o in have:
                if t is None:
                    ok = not any(above(o, m) for m in free) and not (stamped and above(o, stamped[0][2]))
                else:
                    ok = t == -stamped[0][0] and not any(above(stamped[0][2], m) for m in free)
                if ok:
                    best.append((t is None, k))
            out.add((g, f, min(best)[1]))
    return sorted(out)


def test_partial_orders_equal_brute_force(spark):
    rnd = random.Random(11)
    title = lambda: rnd.choice(["Unknown", "plain", "Plain Title", "plain 2", "Plain (Vol. 2)", "a (b)", "x;y", None])
    # records that gain a bracket, a capital and size over time, and lose a list
    teach = [x for i in range(40) for x in ((f"t{i}", 1000 + i, "plain; x", 10, "p", 0, 1), (f"t{i}", 1000 + i, "Plain (x)", 5000, "p", 0, 2))]
    data = [(f"g{i % 60}", i, title(), rnd.choice([None, 0, 3, 100, 9000]), rnd.choice(["D:/x", "p", None]), rnd.choice([None, 0, 1]), rnd.choice([None, None, 1, 2, 3])) for i in range(400)]
    df = groups(spark, teach + data)
    base = df.select(F.col("group_key").alias("g"), F.col("data_id").alias("k"), F.col("updated_at").alias("ts"), "title", "bytes", "init_path")
    learned = survivors.precedence(base, {"title": F.when(survivors.text_value("title"), survivors.text_traits("title")), "init_path": F.when(survivors.text_value("init_path"), survivors.text_traits("init_path")), "bytes": F.when(survivors.size_value("bytes"), survivors.size_traits("bytes"))})
    assert learned["title"] == (0b100001, 0b000100) and learned["init_path"] == (0, 0) and learned["bytes"][0] == sum(1 << i for i in range(3, 12)) and not learned["bytes"][1]
    got = survivors.survivors(df).where("n_records > 1").select("group_key", "field", "data_id")
    assert rows(got) == brute_survivors(data, learned)


def test_currency_query(spark, data):
    from shelfmark.llm import queries

    a, b = (set(rows(f(spark, data))) for f in (queries.p1_found, queries.p1_currency))
    assert {x[:2] for x in a} == {x[:2] for x in b} and a != b


@pytest.mark.parametrize("name", ["p1_found", "p2_found", "p3_found", "p5_found"])
def test_queries_equal_sql(spark, duck, data, name):
    from shelfmark.llm import queries

    df = queries.queries()[name](spark, data)
    rel = duck.sql(queries.oracle_sql()[name])
    assert rows(df.select(*sorted(df.columns))) == order(rel.select(*sorted(rel.columns)).fetchall())
