"""Change plans: resolving, counting, writing them as SQL or batch text, applying and verifying them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.text import bat_quote, blank, sql_quote
from shelfmark.sources.library import Library


def fully_deleted(data: DataFrame, deletes: DataFrame, parent: str = "book", child: str = "id") -> DataFrame:
    """Parents that have children, all of which are to be deleted (relational division)."""
    left = data.join(deletes.select(F.col(child).alias("_d")).distinct(), F.col(child) == F.col("_d"), "left_anti").select(F.col(parent).alias("_p")).where("_p is not null")
    return data.where(F.col(parent).isNotNull()).select(parent).distinct().join(left, F.col(parent) == F.col("_p"), "left_anti")


def empty_parents(books: DataFrame, data: DataFrame) -> DataFrame:
    return books.join(data.select(F.col("book").alias("_b")).where("_b is not null"), F.col("id") == F.col("_b"), "left_anti")


def action_counts(plan: DataFrame, action: str = "action") -> DataFrame:
    return plan.groupBy(action).agg(F.count("*").alias("n")).orderBy(action)


def sql_lines(plan: DataFrame, gone_books: DataFrame, children: list[str], batch: str) -> DataFrame:
    """The plan as SQL text, ``seq, line``: per file in the order (book, data, reason), then books, then sweeps of orphans.

    plan: ``book_id, data_id, reason_code, action, new_title, new_file_basename``.
    """
    spark = plan.sparkSession
    note = lambda a: F.concat(F.lit(f"-- action={a} reason="), blank("reason_code"), F.lit(" book_id="), F.col("book_id").cast("string"), F.lit(" data_id="), F.col("data_id").cast("string"))
    title = F.when(blank("new_title") != "", F.concat(F.lit("UPDATE books SET title = "), sql_quote("new_title"), F.lit(" WHERE id = "), F.col("book_id").cast("string"), F.lit(";")))
    name = F.when(blank("new_file_basename") != "", F.concat(F.lit("UPDATE data SET name = "), sql_quote("new_file_basename"), F.lit(" WHERE id = "), F.col("data_id").cast("string"), F.lit(";")))
    delete = F.concat(F.lit("DELETE FROM data WHERE id = "), F.col("data_id").cast("string"), F.lit(";"))
    lines = F.when(F.col("action") == "delete_file", F.array(note("delete_file"), delete)).when(F.col("action") == "update_metadata", F.array_compact(F.array(note("update_metadata"), title, name))).otherwise(F.array(F.concat(F.lit("-- action="), F.col("action"), F.lit(" data_id="), F.col("data_id").cast("string"), F.lit("; no SQL operation"))))
    files = plan.select(F.struct(F.lit(1).alias("part"), F.col("book_id").alias("b"), F.col("data_id").alias("d"), blank("reason_code").alias("r")).alias("at"), F.posexplode(lines).alias("pos", "line"))
    book = F.col("book_id").cast("string")
    stmt = F.concat(F.lit("DELETE FROM books WHERE id = "), book, F.lit(" AND NOT EXISTS (SELECT 1 FROM data WHERE book = "), book, F.lit(");"))
    books = gone_books.select(F.struct(F.lit(2).alias("part"), F.col("book_id").alias("b"), F.lit(0).cast("bigint").alias("d"), F.lit("").alias("r")).alias("at"), F.lit(0).alias("pos"), stmt.alias("line"))
    head = [(0, i, x) for i, x in enumerate((f"-- batch: {batch}", "BEGIN TRANSACTION;"))]
    tail = [(3, i, f'DELETE FROM "{c}" WHERE book NOT IN (SELECT id FROM books);') for i, c in enumerate(sorted(c for c in children if c != "data"))]
    fixed = spark.createDataFrame([*head, *tail, (4, 0, "COMMIT;")], "part int, i int, line string").select(F.struct("part", F.lit(0).cast("bigint").alias("b"), F.lit(0).cast("bigint").alias("d"), F.lit("").alias("r")).alias("at"), F.col("i").alias("pos"), "line")
    return files.unionByName(books).unionByName(fixed).select(F.struct("at", "pos").alias("seq"), "line")


def parse_sql(lines: DataFrame, line: str = "line") -> DataFrame:
    """``table, id`` of the deletions in SQL text."""
    m = lambda i: F.regexp_extract(line, r"^DELETE FROM (data|books) WHERE id = (\d+)", i)
    return lines.select(m(1).alias("table"), m(2).alias("_id")).where("table <> ''").select("table", F.col("_id").cast("bigint").alias("id"))


def bat_lines(plan: DataFrame, root: str, aside: str) -> DataFrame:
    """File moves as batch text, ``seq, line``: one per book folder, at its first file's place; only folders of books that go as a whole.

    plan: ``book_id, data_id, relative_path, whole_book``; a single file's move names the file.
    """
    slash = F.translate("relative_path", "/", "\\")
    what = F.when(F.col("whole_book"), F.regexp_replace(slash, r"\\[^\\]*$", "")).otherwise(slash)
    first = plan.select("book_id", "data_id", what.alias("what")).groupBy("what").agg(F.min(F.struct("book_id", "data_id")).alias("seq"))
    quoted = lambda c: F.concat(F.lit('"'), bat_quote(c), F.lit('"'))
    return first.select("seq", F.concat(F.lit("move "), quoted(F.concat(F.lit(root + "\\"), F.col("what"))), F.lit(" "), quoted(F.lit(aside))).alias("line"))


def rollback_lines(plan: DataFrame, root: str, aside: str) -> DataFrame:
    """The way back as batch text, ``seq, line``: each folder that files were moved from, at its first file's place, back from where it was put.

    plan: ``book_id, data_id, relative_path, action``; other actions than deleting and putting aside move nothing, nor do rows without a path. Rows without a book come last. Three
    lines a folder: a remark, the check that it is there, the move.
    """
    moved = plan.where(F.col("action").isin("delete_file", "quarantine_file") & (blank("relative_path") != ""))
    folder = F.regexp_replace(F.translate("relative_path", "\\", "/"), "/?[^/]*$", "")
    first = moved.select("book_id", "data_id", F.when(folder == "", ".").otherwise(folder).alias("folder")).groupBy("folder").agg(F.min(F.struct(F.col("book_id").isNull().alias("none"), "book_id", F.col("data_id").isNull().alias("no_file"), "data_id")).alias("at"))
    there, here = (F.concat(F.lit(f'"{p}\\'), bat_quote(F.translate("folder", "/", "\\")), F.lit('"')) for p in (aside, root))
    lines = F.array(F.concat(F.lit("REM rollback book_id="), blank("at.book_id")), F.concat(F.lit("if not exist "), there, F.lit(" echo SKIP: "), there), F.concat(F.lit("if exist "), there, F.lit(" move /Y "), there, F.lit(" "), here))
    return first.select("at", "folder", F.posexplode(lines).alias("pos", "line")).select(F.struct("at", "folder", "pos").alias("seq"), "line")


def verification_log(expected: DataFrame, present: DataFrame) -> DataFrame:
    """Each path of a plan with ``status`` missing or existing, in the order of the log: ``log_order, relative_path, status``, missing ones first."""
    p = present.select(F.col("relative_path").alias("_p")).distinct()
    j = expected.select("relative_path").where("relative_path is not null").distinct().join(p, F.col("relative_path") == F.col("_p"), "left")
    there = F.col("_p").isNotNull()
    return j.select(F.struct(there.alias("later"), "relative_path").alias("log_order"), "relative_path", F.when(there, "existing").otherwise("missing").alias("status"))


def copy_plan(wanted: DataFrame, source: DataFrame, target: DataFrame) -> DataFrame:
    """What copying files comes to, without touching one: ``relative_path, bytes, status``: file_missing, already_synced (there in the same size) or copy.

    All: ``relative_path``; listings with ``actual_bytes``. A repeated path counts once, with its greatest size.
    """
    size = lambda d, n: d.groupBy(F.col("relative_path").alias(f"_{n}")).agg(F.max("actual_bytes").alias(n))
    w = wanted.select("relative_path").where("relative_path <> ''").distinct()
    j = w.join(size(source, "s"), F.col("relative_path") == F.col("_s"), "left").join(size(target, "t"), F.col("relative_path") == F.col("_t"), "left")
    return j.select("relative_path", F.col("s").alias("bytes"), F.when(F.col("_s").isNull(), "file_missing").when(F.col("s").eqNullSafe(F.col("t")) & F.col("_t").isNotNull(), "already_synced").otherwise("copy").alias("status"))


def note_lines(rows: DataFrame) -> DataFrame:
    """A plan that is only remarks: ``seq, line`` of rows with ``sync_id, action, source_book_id, target_book_id``."""
    part = lambda name, c: F.concat(F.lit(f" {name}="), F.coalesce(F.col(c).cast("string"), F.lit("-")))
    return rows.select(F.col("sync_id").alias("seq"), F.concat(F.lit("-- sync_id="), blank("sync_id"), part("action", "action"), part("source_book", "source_book_id"), part("target_book", "target_book_id")).alias("line"))


def dry_run(plan: DataFrame, status: str = "status") -> DataFrame:
    """What of a plan a dry run shows: all but the changes that would be made by themselves; a null status is shown."""
    return plan.where(~F.col(status).eqNullSafe(F.lit("update_file")))


def affected_rows(data: DataFrame, books: DataFrame, parent: str = "book") -> DataFrame:
    """``book, n_files`` of the named books that have files."""
    return data.join(books.select(F.col("id").alias("_b")).distinct(), F.col(parent) == F.col("_b"), "left_semi").groupBy(F.col(parent).alias("book")).agg(F.count("*").alias("n_files"))


def preview(title_handoffs: DataFrame, basename_handoffs: DataFrame) -> DataFrame:
    """``what, n_auto, n_manual``: how many repairs can be made and how many are left to people; titles count by book, base names by file."""
    one = lambda d, what, key: d.groupBy(key).agg(F.bool_or(F.col("status") == "update_file").alias("a")).agg(F.count_if("a").alias("n_auto"), F.count_if(~F.col("a")).alias("n_manual")).select(F.lit(what).alias("what"), "n_auto", "n_manual")
    return one(title_handoffs, "title", "id").unionByName(one(basename_handoffs, "file_basename", "id"))


def update_names(df: DataFrame, new: DataFrame, column: str, unique: list[str]) -> tuple[DataFrame, DataFrame]:
    """(updated table, ``id, status``): updated, or manual_confirming where the new value would break the unique key.

    new: ``id, value``. A value is refused if another row holds the resulting key already or a lesser id claims it. The statuses cover
    ids that exist; of several values for an id the least is taken.
    """
    n = new.groupBy(F.col("id").alias("_id")).agg(F.min("value").alias("_v"))
    j = df.join(n, df["id"] == n["_id"], "left")
    key = [F.coalesce("_v", c) if c == column else F.col(c) for c in unique]
    claimed = j.select("id", "_v", *[k.alias(f"_k{i}") for i, k in enumerate(key)], *[F.col(c).alias(f"_o{i}") for i, c in enumerate(unique)])
    ks = [f"_k{i}" for i in range(len(unique))]
    wants = claimed.where("_v is not null")
    holds = claimed.select(F.col("id").alias("_hid"), *[F.col(f"_o{i}").alias(f"_k{i}") for i in range(len(unique))])
    held = wants.join(holds, ks).where("id <> _hid").select("id")
    firsts = wants.groupBy(*ks).agg(F.min("id").alias("_first"))
    late = wants.join(firsts, ks).where("id <> _first").select("id")
    bad = held.unionByName(late).distinct().withColumnRenamed("id", "_bad")
    st = wants.join(bad, F.col("id") == F.col("_bad"), "left").select("id", F.when(F.col("_bad").isNull(), "updated").otherwise("manual_confirming").alias("status"))
    good = st.where("status = 'updated'").select(F.col("id").alias("_ok"))
    out = j.join(good, j["id"] == good["_ok"], "left").select(*[F.when(F.col("_ok").isNotNull(), F.col("_v")).otherwise(F.col(column)).alias(column) if c == column else F.col(c) for c in df.columns])
    return out, st


def verify(before: Library, after: Library, data_ids: DataFrame) -> dict[str, int]:
    """Counts of an applied deletion: planned, gone, still there, added, books gone and to be expected to. fully_executed is 1 if all agree.

    A book is expected to go if all its files do.
    """
    b, a, p = before["data"].select("id"), after["data"].select("id"), data_ids.select("id").distinct()
    out = {"planned": p.count(), "removed": b.join(a, "id", "left_anti").count(), "remaining": p.join(a, "id", "left_semi").count(), "added": a.join(b, "id", "left_anti").count(), "books_removed": before["books"].select("id").join(after["books"].select("id"), "id", "left_anti").count()}
    out["books_expected"] = fully_deleted(before["data"], p).join(before["books"].select(F.col("id").alias("_b")), F.col("book") == F.col("_b"), "left_semi").count()
    return out | {"fully_executed": int(out["planned"] == out["removed"] and not out["remaining"] and not out["added"] and out["books_removed"] == out["books_expected"])}
