"""Set-oriented upsert of an incremental library into a full one, with a policy for conflicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.ids import with_surrogate
from shelfmark.functions.text import ascii_lower, blank
from shelfmark.rules import POLICIES
from shelfmark.schemas import LINKS
from shelfmark.sources.library import Library


def _top(df: DataFrame) -> int:
    return df.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]


def resolve_books(full: Library, inc: Library, matches: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(``source_book, target_book``, new book rows): a matched book goes to its target, any other gets one new id.

    matches: ``book_id, data_id, target_book_id``; of a book's files the least with a target decides.
    """
    per = matches.groupBy("book_id").agg(F.min_by("target_book_id", F.when(F.col("target_book_id").isNotNull(), F.col("data_id"))).alias("target_book"))
    new = with_surrogate(per.where("target_book is null").select("book_id"), "target_book", ["book_id"], start=_top(full["books"]))
    to = per.where("target_book is not null").select("book_id", "target_book").unionByName(new.select("book_id", "target_book")).withColumnRenamed("book_id", "source_book")
    rows = inc["books"].join(new.withColumnRenamed("book_id", "_b"), F.col("id") == F.col("_b")).select(*[F.col("target_book").alias("id") if c == "id" else F.col(c) for c in inc["books"].columns])
    return to, rows


def insert_files(full: DataFrame, files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(full files with the new ones, ``source_id, status``): one file per (book, format).

    files: rows of ``data`` whose book is the target's. Status: already_synced (same size and name there), conflict (another file there, or a lesser id
    claims the place), inserted.
    """
    fmt = F.upper(F.trim(blank("format")))
    have = full.groupBy(F.col("book").alias("_b"), fmt.alias("_f")).agg(F.min_by(F.struct(F.col("uncompressed_size").alias("size"), "name"), "id").alias("_has"))
    first = files.groupBy(F.col("book").alias("_b2"), fmt.alias("_f2")).agg(F.min("id").alias("_first"))
    j = files.join(have, (F.col("book") == F.col("_b")) & (fmt == F.col("_f")), "left").join(first, (F.col("book") == F.col("_b2")) & (fmt == F.col("_f2")))
    status = F.when(F.col("_has").isNotNull(), F.when(F.col("_has.size").eqNullSafe(F.col("uncompressed_size")) & F.col("_has.name").eqNullSafe(F.col("name")), "already_synced").otherwise("conflict")).when(F.col("id") != F.col("_first"), "conflict").otherwise("inserted")
    st = j.withColumn("status", status)
    fresh = with_surrogate(st.where("status = 'inserted'").select(*files.columns), "_new", ["id"], start=_top(full))
    return full.unionByName(fresh.select(*[F.col("_new").alias("id") if c == "id" else F.col(c) for c in files.columns]), allowMissingColumns=True), st.select(F.col("id").alias("source_id"), "status")


def upsert_dictionary(full: DataFrame, values: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """(full dictionary with new rows, ``_key, dict_id``); values are equal if they are without regard to ASCII case, the least id counts."""
    key = ascii_lower(F.col(column).cast("string"))
    have = full.where(F.col(column).isNotNull()).groupBy(key.alias("_key")).agg(F.min("id").alias("dict_id"))
    want = values.where(F.col(column).isNotNull()).groupBy(key.alias("_key")).agg(F.min(column).alias(column))
    new = with_surrogate(want.join(have, "_key", "left_anti"), "dict_id", ["_key"], start=_top(full))
    rows = full.unionByName(new.select(F.col("dict_id").alias("id"), column), allowMissingColumns=True)
    return rows, have.unionByName(new.select("_key", "dict_id"))


def upsert_links(full_link: DataFrame, wanted: DataFrame, column: str, several: bool, policy: str) -> tuple[DataFrame, DataFrame]:
    """(links, ``book, status``): several values per book are added where absent; a single one is inserted, kept, overwritten or a conflict.

    wanted: ``book, dict_id``; for a single value the least counts.
    """
    if policy not in POLICIES:
        raise ValueError(f"unknown policy {policy!r}")
    link_cols = ["id", "book", column]
    have = full_link.select(F.col("book").alias("_b"), F.col(column).alias("_v"))
    if several:
        fresh = wanted.distinct().join(have, (F.col("book") == F.col("_b")) & (F.col("dict_id") == F.col("_v")), "left_anti")
        rows = with_surrogate(fresh, "id", ["book", "dict_id"], start=_top(full_link)).select("id", "book", F.col("dict_id").alias(column))
        st = wanted.select("book").distinct().join(fresh.select("book", F.lit("inserted").alias("_s")).distinct(), "book", "left").select("book", F.coalesce("_s", F.lit("already_synced")).alias("status"))
        return full_link.select(*link_cols).unionByName(rows), st
    one = wanted.groupBy("book").agg(F.min("dict_id").alias("dict_id"))
    old = have.groupBy("_b").agg(F.min("_v").alias("_v"))
    j = one.join(old, F.col("book") == F.col("_b"), "left")
    clash = F.lit("overwritten" if policy == "overwrite" else "conflict")
    st = j.select("book", "dict_id", F.when(F.col("_v").isNull(), "inserted").when(F.col("_v") == F.col("dict_id"), "already_synced").otherwise(clash).alias("status"))
    fresh = with_surrogate(st.where("status = 'inserted'"), "id", ["book"], start=_top(full_link)).select("id", "book", F.col("dict_id").alias(column))
    over = st.where("status = 'overwritten'").select(F.col("book").alias("_ob"), F.col("dict_id").alias("_ov"))
    kept = full_link.join(over, F.col("book") == F.col("_ob"), "left").select("id", "book", F.coalesce("_ov", column).alias(column))
    return kept.unionByName(fresh), st.select("book", "status")


def upsert_values(full: DataFrame, wanted: DataFrame, keys: list[str], value: str, policy: str) -> tuple[DataFrame, DataFrame]:
    """(table, keys + ``status``) for comments and identifiers: one value per key. A blank value is filled under fill-missing and overwrite."""
    if policy not in POLICIES:
        raise ValueError(f"unknown policy {policy!r}")
    w = wanted.groupBy(*keys).agg(F.min(value).alias("_new"))
    same: Column = F.lit(True)
    have = full.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col(value).alias("_old"), F.lit(True).alias("_has")).dropDuplicates([f"_{k}" for k in keys])
    for k in keys:
        same &= F.col(k) == F.col(f"_{k}")
    j = w.join(have, same, "left")
    empty = F.trim(blank("_old")) == ""
    st = j.select(*keys, "_new", F.when(F.col("_has").isNull(), "inserted").when(F.trim(blank("_old")) == F.trim(blank("_new")), "already_synced").when(empty & F.lit(policy in ("fill-missing", "overwrite")), "filled_missing").when(F.lit(policy == "overwrite"), "overwritten").otherwise("conflict").alias("status"))
    change = st.where("status in ('filled_missing', 'overwritten')").select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("_new").alias("_c"))
    kept = full.join(change, same, "left").select(*[F.coalesce("_c", value).alias(value) if c == value else F.col(c) for c in full.columns])
    fresh = with_surrogate(st.where("status = 'inserted'"), "id", keys, start=_top(full)).select("id", *keys, F.col("_new").alias(value))
    return kept.unionByName(fresh, allowMissingColumns=True), st.select(*keys, "status")


def upsert(full: Library, inc: Library, matches: DataFrame, policy: str = "fill-missing") -> tuple[Library, DataFrame]:
    """The full library with the incremental one merged in, and a report ``what, source_book, status``.

    Everything is a join of whole relations; a second run changes nothing but finds all synced. matches as in resolve_books.
    """
    to, new_books = resolve_books(full, inc, matches)
    out = full.replace(books=full["books"].unionByName(new_books, allowMissingColumns=True))
    d = inc["data"].join(to, F.col("book") == F.col("source_book")).select(*[F.col("target_book").alias("book") if c == "book" else F.col(c) for c in inc["data"].columns])
    data, st = insert_files(full["data"], d)
    out = out.replace(data=data)
    report = st.join(inc["data"].select(F.col("id").alias("source_id"), F.col("book").alias("source_book")), "source_id").select(F.lit("data").alias("what"), "source_book", "status")
    back = to.select(F.col("target_book").alias("book"), "source_book")
    for name, (value, link, column, several) in LINKS.items():
        if not {name, link} <= set(inc) or not {name, link} <= set(full):
            continue
        dict_rows, ids = upsert_dictionary(full[name], inc[name], value)
        v = inc[name].select(F.col("id").alias("_d"), ascii_lower(F.col(value).cast("string")).alias("_key"))
        wanted = inc[link].join(v, F.col(column) == F.col("_d")).join(ids, "_key").join(to, F.col("book") == F.col("source_book")).select(F.col("target_book").alias("book"), "dict_id")
        links, st = upsert_links(full[link], wanted, column, several, policy)
        out = out.replace(**{name: dict_rows, link: links})
        report = report.unionByName(st.join(back, "book").select(F.lit(name).alias("what"), "source_book", "status"))
    for name, keys, value in (("comments", ["book"], "text"), ("identifiers", ["book", "type"], "val")):
        if name in inc and name in full:
            w = inc[name].join(to, F.col("book") == F.col("source_book")).select(F.col("target_book").alias("book"), *[k for k in keys if k != "book"], value)
            rows, st = upsert_values(full[name], w, keys, value, policy)
            out = out.replace(**{name: rows})
            report = report.unionByName(st.join(back, "book").select(F.lit(name).alias("what"), "source_book", "status"))
    return out, report
