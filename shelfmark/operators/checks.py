"""Integrity and correctness checks of a library, its deletions and its files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.text import blank, normalize
from shelfmark.operators.reports import examples
from shelfmark.sources.library import Library


def integrity(lib: Library) -> DataFrame:
    """``check, n``: orphan rows of each relation that hangs on books, books without files, repeated (book, format)."""
    ids = lib["books"].select(F.col("id").alias("_b"))
    out = None
    for n in lib.children():
        bad = lib[n].join(ids, F.col("book") == F.col("_b"), "left_anti").agg(F.count("*").alias("n")).select(F.lit(f"orphan_{n}").alias("check"), "n")
        out = bad if out is None else out.unionByName(bad)
    owned = lib["data"].select(F.col("book").alias("_o")).where("_o is not null")
    empty = lib["books"].join(owned, F.col("id") == F.col("_o"), "left_anti").agg(F.count("*").alias("n")).select(F.lit("empty_books").alias("check"), "n")
    twice = duplicate_keys(lib["data"], ["book", "format"]).agg(F.count("*").alias("n")).select(F.lit("duplicate_formats").alias("check"), "n")
    return (empty if out is None else out.unionByName(empty)).unionByName(twice)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def id_diff(before: DataFrame, after: DataFrame, key: str = "id") -> DataFrame:
    """``key, change``: removed or added."""
    b, a = before.select(key).distinct(), after.select(key).distinct()
    return b.join(a, key, "left_anti").select(key, F.lit("removed").alias("change")).unionByName(a.join(b, key, "left_anti").select(key, F.lit("added").alias("change")))


def equal_sets(a: DataFrame, b: DataFrame, key: str = "id") -> bool:
    return id_diff(a, b, key).isEmpty()


def find_files(expected: DataFrame, listing: DataFrame) -> DataFrame:
    """Each expected file with how it was found: exact, single_same_format, name_match, ambiguous or missing.

    expected: ``data_id, relative_path, title``; listing: ``relative_path``. Beside the exact path the folder's only file of the format counts, then the
    only one whose name has the title or base name in it.
    """
    parts = lambda d: d.withColumn("_dir", F.regexp_extract("relative_path", r"^(.*)/[^/]*$", 1)).withColumn("_ext", F.lower(F.regexp_extract("relative_path", r"\.([^./]*)$", 1))).withColumn("_name", F.regexp_extract("relative_path", r"([^/]*?)(?:\.[^./]*)?$", 1))
    e = parts(expected)
    files = parts(listing.select("relative_path").distinct())
    exact = files.select(F.col("relative_path").alias("_hit"))
    per = files.groupBy(F.col("_dir").alias("_d2"), F.col("_ext").alias("_e2")).agg(F.count("*").alias("_n"))
    # names are probed only where neither the exact path nor a single file answers
    open_ = e.join(exact, F.col("relative_path") == F.col("_hit"), "left_anti").join(per.where("_n > 1"), (F.col("_dir") == F.col("_d2")) & (F.col("_ext") == F.col("_e2")), "left_semi")
    named = open_.join(files.select(F.col("_dir").alias("_d3"), F.col("_ext").alias("_e3"), F.col("_name").alias("_n3")), (F.col("_dir") == F.col("_d3")) & (F.col("_ext") == F.col("_e3")))
    t, n3, own = normalize("title"), normalize("_n3"), normalize("_name")
    named = named.where(((t != "") & n3.contains(t)) | ((own != "") & n3.contains(own))).groupBy("data_id").agg(F.count("*").alias("_m"))
    j = e.join(exact, F.col("relative_path") == F.col("_hit"), "left").join(per, (F.col("_dir") == F.col("_d2")) & (F.col("_ext") == F.col("_e2")), "left").join(named, "data_id", "left")
    how = F.when(F.col("_hit").isNotNull(), "exact").when(F.col("_n") == 1, "single_same_format").when(F.col("_m") == 1, "name_match").when(F.col("_n") > 1, "ambiguous").otherwise("missing")
    return j.select(*expected.columns, how.alias("found_by"))


def diagnose(found: DataFrame, listing: DataFrame, n: int = 20) -> DataFrame:
    """The first n missing files by path with what lies in their folder: ``relative_path, n_siblings, siblings`` (the first five names)."""
    folder = lambda c: F.regexp_extract(c, r"^(.*)/[^/]*$", 1)
    gone = found.where("found_by in ('missing', 'ambiguous')").select("relative_path").distinct().orderBy("relative_path").limit(n).withColumn("_dir", folder("relative_path"))
    near = listing.select("relative_path").distinct().select(folder("relative_path").alias("_d"), F.regexp_extract("relative_path", r"([^/]*)$", 1).alias("_name")).join(gone.select(F.col("_dir").alias("_g")).distinct(), F.col("_d") == F.col("_g"), "left_semi")
    first = examples(near, ["_d"], ["_name"]).groupBy("_d").agg(F.array_sort(F.collect_list("_name")).alias("siblings"))
    counts = near.groupBy(F.col("_d").alias("_c")).agg(F.count("*").alias("n_siblings"))
    return gone.join(first, F.col("_dir") == F.col("_d"), "left").join(counts, F.col("_dir") == F.col("_c"), "left").select("relative_path", F.coalesce("n_siblings", F.lit(0)).alias("n_siblings"), F.coalesce("siblings", F.array().cast("array<string>")).alias("siblings"))


def three_way(planned: DataFrame, written: DataFrame, before: DataFrame, after: DataFrame, key: str = "id") -> DataFrame:
    """``check, n``: ids planned but not written as SQL, written but not planned, planned and still there, gone without a plan. All zero is sound."""
    ids = lambda d: d.select(key).where(F.col(key).isNotNull()).distinct()
    p, w, b, a = ids(planned), ids(written), ids(before), ids(after)
    facts = {"planned_not_written": p.join(w, key, "left_anti"), "written_not_planned": w.join(p, key, "left_anti"), "still_there": p.join(a, key, "left_semi"), "gone_without_plan": b.join(a, key, "left_anti").join(p, key, "left_anti")}
    out = None
    for name, d in facts.items():
        one = d.agg(F.count("*").alias("n")).select(F.lit(name).alias("check"), "n")
        out = one if out is None else out.unionByName(one)
    return out


def missing_share(found: DataFrame) -> float:
    r = found.agg(F.count("*").alias("n"), F.count_if(F.col("found_by").isin("missing", "ambiguous")).alias("m")).first()
    return r.m / r.n if r.n else 0.0


def contains_all(lines: DataFrame, words: list[str], line: str = "line") -> DataFrame:
    """``word, n``: in how many lines each stands."""
    c = lines.agg(*[F.count_if(blank(line).contains(w)).alias(f"c{i}") for i, w in enumerate(words)])
    return c.select(F.explode(F.array(*[F.struct(F.lit(w).alias("word"), F.col(f"c{i}").alias("n")) for i, w in enumerate(words)])).alias("x")).select("x.*")
