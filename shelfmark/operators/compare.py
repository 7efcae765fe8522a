"""Incremental library against a full one: cascading match, set and value comparison, dictionary and child diffs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.text import book_key, normalize, strip, sync_key
from shelfmark.schemas import LINKS
from shelfmark.sources.library import Library


def profiles(lib: Library) -> DataFrame:
    """One row per book: ``book, authors, tags, languages, ratings, publishers, series`` as sorted sets, ``comment``, ``identifiers`` as a map.

    Each child is aggregated once; no child row is looked up per book.
    """
    out = lib["books"].select(F.col("id").alias("book"))
    for name, (value, link, column, _) in LINKS.items():
        if name in lib and link in lib:
            d = lib[name].select(F.col("id").alias("_d"), F.col(value).cast("string").alias("_v"))
            one = lib[link].join(d, F.col(column) == F.col("_d")).groupBy("book").agg(F.array_sort(F.collect_set("_v")).alias(name))
            out = out.join(one, "book", "left")
        else:
            out = out.withColumn(name, F.array().cast("array<string>"))
        out = out.withColumn(name, F.coalesce(name, F.array().cast("array<string>")))
    c = lib["comments"].groupBy("book").agg(F.min_by("text", "id").alias("comment")) if "comments" in lib else None
    out = out.join(c, "book", "left") if c is not None else out.withColumn("comment", F.lit(None).cast("string"))
    if "identifiers" in lib:
        last = lib["identifiers"].groupBy("book", "type").agg(F.max_by("val", "id").alias("val"))
        i = last.groupBy("book").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("type", "val")))).alias("identifiers"))
        out = out.join(i, "book", "left")
    else:
        out = out.withColumn("identifiers", F.lit(None).cast("map<string,string>"))
    return out


def profile_text(columns: list[str]) -> Column:
    """name=value, value | name=..., in the order given."""
    return F.concat_ws(" | ", *[F.concat(F.lit(f"{c}="), F.array_join(c, ", ")) for c in columns])


def primary_author(lib: Library) -> DataFrame:
    """``book, author``: the author of the first link."""
    a = lib["authors"].select(F.col("id").alias("_a"), "name")
    return lib["books_authors_link"].join(a, F.col("author") == F.col("_a")).groupBy("book").agg(F.min_by("name", "id").alias("author"))


def compare_sets(a: Column, b: Column) -> tuple[Column, Column]:
    """(status, message) of two sorted sets: empty, same, source_only, target_only or delta."""
    x, y = F.array_sort(F.array_except(a, b)), F.array_sort(F.array_except(b, a))
    text = lambda v: F.array_join(v, ", ")
    no_x, no_y = F.size(x) == 0, F.size(y) == 0
    status = F.when((F.size(a) == 0) & (F.size(b) == 0), "empty").when(no_x & no_y, "same").when(no_y, "source_only").when(no_x, "target_only").otherwise("delta")
    parts = F.concat_ws("; ", F.when(~no_x, F.concat(F.lit("source_only="), text(x))), F.when(~no_y, F.concat(F.lit("target_only="), text(y))))
    message = F.when(status == "empty", "same(empty)").when(status == "same", F.concat(F.lit("same: "), text(F.array_sort(a)))).otherwise(F.concat(F.lit("delta: "), parts))
    return status, message


def compare_values(a: Column, b: Column) -> tuple[Column, Column]:
    """(status, message) of two values, blank ones missing: empty, target_missing, source_missing, same or conflict."""
    x, y = strip(F.coalesce(a.cast("string"), F.lit(""))), strip(F.coalesce(b.cast("string"), F.lit("")))
    status = F.when((x == "") & (y == ""), "empty").when(y == "", "target_missing").when(x == "", "source_missing").when(x == y, "same").otherwise("conflict")
    message = F.when(status == "empty", "same(empty)").when(status == "target_missing", F.concat(F.lit("target_missing: "), x)).when(status == "source_missing", F.concat(F.lit("source_missing: "), y)).when(status == "same", F.concat(F.lit("same: "), x)).otherwise(F.concat(F.lit("conflict: source="), x, F.lit("; target="), y))
    return status, message


def compare_comments(a: Column, b: Column) -> tuple[Column, Column]:
    """As compare_values, with lengths in the message."""
    x, y = strip(F.coalesce(a, F.lit(""))), strip(F.coalesce(b, F.lit("")))
    status, _ = compare_values(a, b)
    n = lambda v: F.length(v).cast("string")
    message = F.when(status == "empty", "same(empty)").when(status == "target_missing", F.concat(F.lit("target_missing: source_len="), n(x))).when(status == "source_missing", F.concat(F.lit("source_missing: target_len="), n(y))).when(status == "same", F.concat(F.lit("same: len="), n(x))).otherwise(F.concat(F.lit("conflict: source_len="), n(x), F.lit("; target_len="), n(y)))
    return status, message


def compare_maps(a: Column, b: Column) -> tuple[Column, Column]:
    """(status, message) of two maps, key by key in order: empty, same or delta, and conflict if a key has two values."""
    none = F.create_map().cast("map<string,string>")
    x, y = F.coalesce(a, none), F.coalesce(b, none)
    keys = F.array_sort(F.array_union(F.map_keys(x), F.map_keys(y)))

    def one(k: Column) -> Column:
        u, v = F.element_at(x, k), F.element_at(y, k)
        return F.when(u.isNull(), F.concat(k, F.lit(":source_missing(target="), v, F.lit(")"))).when(v.isNull(), F.concat(k, F.lit(":target_missing(source="), u, F.lit(")"))).when(u == v, F.concat(k, F.lit(":same("), u, F.lit(")"))).otherwise(F.concat(k, F.lit(":conflict(source="), u, F.lit(",target="), v, F.lit(")")))

    clash = F.exists(keys, lambda k: F.coalesce(F.element_at(x, k) != F.element_at(y, k), F.lit(False)))
    gap = F.exists(keys, lambda k: F.element_at(x, k).isNull() | F.element_at(y, k).isNull())
    lacks = F.exists(keys, lambda k: F.element_at(y, k).isNull())
    status = F.when(F.size(keys) == 0, "empty").when(clash, "conflict").when(lacks, "target_missing").when(gap, "source_missing").otherwise("same")
    text = F.array_join(F.transform(keys, one), "; ")
    message = F.when(F.size(keys) == 0, "same(empty)").when(status == "same", F.concat(F.lit("same: "), text)).otherwise(F.concat(F.lit("delta: "), text))
    return status, message


#: Severity of each status: a conflict outweighs what the target lacks, that what it has more.
SEVERITY = {"conflict": 3, "target_missing": 2, "source_only": 2, "delta": 2, "source_missing": 1, "target_only": 1, "same": 0, "empty": 0}


def rollup(statuses: list[Column]) -> Column:
    """The worst of several statuses: conflict, target_missing, target_extra or same."""
    rank = [reduce(lambda acc, kv, s=s: acc.when(s == kv[0], kv[1]), SEVERITY.items(), F.when(F.lit(False), 0)).otherwise(0) for s in statuses]
    worst = F.greatest(*rank) if len(rank) > 1 else rank[0]
    return F.when(worst == 3, "conflict").when(worst == 2, "target_missing").when(worst == 1, "target_extra").otherwise("same")


def has_delta(statuses: list[Column]) -> Column:
    """Something the target lacks could be filled in."""
    return reduce(lambda a, b: a | b, [s.isin("target_missing", "source_only", "delta") for s in statuses])


def first_by(df: DataFrame, keys: dict[str, Column], order: list[str], last: bool = False) -> DataFrame:
    """Per key the first (or last) row by the order, as struct ``hit``; keys named as given. Rows with a null key part are left out."""
    k = df.select(*[c.alias(n) for n, c in keys.items()], F.struct(*[F.col(o) for o in order]).alias("_o"), F.struct(*df.columns).alias("_r"))
    for n in keys:
        k = k.where(F.col(n).isNotNull())
    agg = F.max_by("_r", "_o") if last else F.min_by("_r", "_o")
    return k.groupBy(*keys).agg(agg.alias("hit"))


def cascade(source: DataFrame, target: DataFrame, order: tuple[str, str] = ("book_id", "data_id")) -> DataFrame:
    """Each source file with its match: ``matched_by`` (file, path, title_author, title, none) and the target's ids.

    Both: ``book_id, data_id, title, author, ext, bytes, relative_path``. Branches in this order: equal title, format and size (the last target
    row counts); equal path with another size; equal title and author (the first); equal title (the first). Targets are reduced to one
    row per key before each join, so no join multiplies rows. A null size or title is a value of its own in the file key.
    """
    size = F.coalesce(F.col("bytes").cast("string"), F.lit("None"))
    file_key = {"f1": sync_key("title"), "f2": sync_key("ext"), "f3": size}
    o = list(order)
    by_file = first_by(target, file_key, o, last=True).withColumnRenamed("hit", "h_file")
    by_path = first_by(target, {"p": F.col("relative_path")}, o).withColumnRenamed("hit", "h_path")
    by_book = first_by(target, {"b": book_key("title", "author")}, o).withColumnRenamed("hit", "h_book")
    by_title = first_by(target, {"t": normalize("title")}, o).withColumnRenamed("hit", "h_title")
    s = source.select("*", *[c.alias(n) for n, c in file_key.items()], F.col("relative_path").alias("p"), book_key("title", "author").alias("b"), normalize("title").alias("t"))
    j = s.join(by_file, ["f1", "f2", "f3"], "left").join(by_path, "p", "left").join(by_book, "b", "left").join(by_title, "t", "left")
    other_size = F.col("h_path").isNotNull() & ~F.col("h_path.bytes").eqNullSafe(F.col("bytes"))
    by = F.when(F.col("h_file").isNotNull(), "file").when(other_size, "path").when(F.col("h_book").isNotNull(), "title_author").when(F.col("h_title").isNotNull(), "title").otherwise("none")
    pick = lambda c: F.when(by == "file", F.col(f"h_file.{c}")).when(by == "path", F.col(f"h_path.{c}")).when(by == "title_author", F.col(f"h_book.{c}")).when(by == "title", F.col(f"h_title.{c}"))
    return j.select(*source.columns, by.alias("matched_by"), pick("book_id").alias("target_book_id"), pick("data_id").alias("target_data_id"))


def scan_action(matched_by: str = "matched_by", delta: Column | None = None) -> Column:
    """What a match recommends: a new book, filling in, keeping, or a report."""
    m = F.col(matched_by)
    return F.when(m == "none", "insert_book").when(m == "path", "keep_target").when(m == "file", F.when(delta, "fill_missing_metadata").otherwise("keep_target") if delta is not None else F.lit("keep_target")).otherwise("report_only")


def sides(df: DataFrame, source: list[str], target: list[str], present: str, names: tuple[str, str] = ("incremental", "full")) -> DataFrame:
    """Two rows per match, one per side, under the source's column names; the target's only if ``present`` is not null."""
    keep = [c for c in df.columns if c not in source and c not in target]
    row = lambda side, cols: F.struct(F.lit(side).alias("compare_side"), *[F.col(c).alias(n) for c, n in zip(cols, source)])
    both = F.filter(F.array(row(names[0], source), F.when(F.col(present).isNotNull(), row(names[1], target))), lambda x: x.isNotNull())
    return df.select(*keep, F.explode(both).alias("_x")).select(*keep, "_x.*")


def diff_dictionary(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Full outer diff of two dictionaries by lower-case trimmed key: ``dict_key, source_id, target_id, status, action``.

    The row of the least id stands for a key. Status: same, conflict (other columns differ), source_only, target_only. Actions: keep_target,
    relink_metadata (same but under another id), merge_metadata, insert.
    """
    rest = [c for c in source.columns if c in target.columns and c not in ("id", key)]
    k = lambda d: first_by(d.where(F.col(key).isNotNull()), {"dict_key": F.lower(F.trim(F.col(key).cast("string")))}, ["id"])
    s, t = k(source).withColumnRenamed("hit", "s"), k(target).withColumnRenamed("hit", "t")
    j = s.join(t, "dict_key", "full_outer")
    vals = lambda side: F.struct(F.col(f"{side}.{key}").alias("k"), *[F.col(f"{side}.{c}").alias(c) for c in rest])
    status = F.when(F.col("t").isNull(), "source_only").when(F.col("s").isNull(), "target_only").when(vals("s").eqNullSafe(vals("t")), "same").otherwise("conflict")
    action = F.when(status == "source_only", "insert").when(status == "target_only", "keep_target").when(status == "conflict", "merge_metadata").when(F.col("s.id") == F.col("t.id"), "keep_target").otherwise("relink_metadata")
    return j.select("dict_key", F.col("s.id").alias("source_id"), F.col("t.id").alias("target_id"), status.alias("status"), action.alias("action"))


def diff_dictionaries(inc: Library, full: Library) -> DataFrame:
    """diff_dictionary() of every dictionary that both libraries have, with its name in ``scope``."""
    out = None
    for name, (value, *_) in LINKS.items():
        if name in inc and name in full:
            d = diff_dictionary(inc[name], full[name], value).select(F.lit(name).alias("scope"), "*")
            out = d if out is None else out.unionByName(d)
    if out is None:
        raise ValueError("the libraries share no dictionary")
    return out


def diff_library_children(inc: Library, full: Library, books: DataFrame) -> DataFrame:
    """diff_children() of comments (one a book, under the key comment) and identifiers, with ``scope``. books: ``source_book, target_book``."""
    out = None
    for name, key, value in (("comments", None, "text"), ("identifiers", "type", "val")):
        if name in inc and name in full:
            s, t = (d[name].select("book", (F.col(key) if key else F.lit("comment")).alias("key"), F.col(value).alias("value")) for d in (inc, full))
            d = diff_children(s, t, books, "key", "value").select(F.lit(name).alias("scope"), "*")
            out = d if out is None else out.unionByName(d)
    if out is None:
        raise ValueError("the libraries share neither comments nor identifiers")
    return out


def book_maps(matches: DataFrame, order: str = "data_id") -> tuple[DataFrame, DataFrame]:
    """Both directions, ``source_book, target_book`` each: the first match of every source book, and the first of every target book.

    The first by ``order`` counts, with or without a partner; so several source books may lead to one target, which leads back to one of them.
    """
    first = lambda key, other: matches.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(order, F.col(other).isNull().alias("none"), other)).alias("m")).select(key, F.col(f"m.{other}").alias(other))
    named = lambda d: d.select(F.col("book_id").alias("source_book"), F.col("target_book_id").alias("target_book"))
    return named(first("book_id", "target_book_id")), named(first("target_book_id", "book_id"))


def diff_children(source: DataFrame, target: DataFrame, books: DataFrame, key: str, value: str) -> DataFrame:
    """Diff of rows that hang on mapped books: ``source_book, target_book, child_key, source_value, target_value, status``.

    Children: ``book`` and the two columns; of equal (book, key) the least value counts. Source books without a partner give
    source_only, target books no source book maps to target_only with a null source book.
    """
    s = source.groupBy(F.col("book").alias("source_book"), F.lower(F.trim(F.col(key).cast("string"))).alias("child_key")).agg(F.min(value).alias("source_value")).join(books, "source_book", "left")
    t = target.groupBy(F.col("book").alias("target_book"), F.lower(F.trim(F.col(key).cast("string"))).alias("child_key")).agg(F.min(value).alias("target_value"))
    mapped = t.join(books.where("target_book is not null"), "target_book", "left").withColumnRenamed("source_book", "_s").withColumnRenamed("target_book", "_t").withColumnRenamed("child_key", "_k")
    j = s.join(mapped.withColumn("_t_has", F.lit(True)), (s["source_book"] == F.col("_s")) & s["child_key"].eqNullSafe(F.col("_k")), "full_outer")
    status = F.when(F.col("_t_has").isNull(), "source_only").when(s["source_book"].isNull(), "target_only").when(F.col("source_value").eqNullSafe(F.col("target_value")), "same").otherwise("conflict")
    return j.select(F.coalesce(s["source_book"], "_s").alias("source_book"), F.coalesce(s["target_book"], "_t").alias("target_book"), F.coalesce("child_key", "_k").alias("child_key"), "source_value", "target_value", status.alias("status"))


def same_content(a: DataFrame, b: DataFrame) -> bool:
    """Whether two tables hold the same rows, by an order-free checksum of both."""
    cols = sorted(a.columns)
    if cols != sorted(b.columns):
        return False
    digest = lambda d: d.select(F.xxhash64(*cols).alias("h")).agg(F.count("*"), F.bit_xor("h"), F.sum(F.pmod("h", F.lit(1 << 31)))).first()
    return digest(a) == digest(b)
