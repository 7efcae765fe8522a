"""Rows of the reports that people read and send back: manual reviews, repair reports, comparison rows, statuses of a merge."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.codec import partial_hint
from shelfmark.functions.ids import stable_id, sync_id, with_surrogate
from shelfmark.functions.text import blank
from shelfmark.operators import compare
from shelfmark.operators.dedup import first_hit
from shelfmark.rules import NOOP_ACTIONS, REASON_DETAILS, RuleSet
from shelfmark.schemas import CANDIDATE, MANUAL_REVIEW
from shelfmark.sources.files import row_image
from shelfmark.sources.library import Library, relative_path


def _handoff(rows: DataFrame, report: DataFrame | None, key: str, kind: str, only: str) -> DataFrame:
    """Adds the four columns of a repair report where the row's reason is ``only``, else empty; absent rows say why."""
    names = [f"step2_repair_{kind}_repair_status", f"step2_repair_{kind}_repair_reason", f"step2_repair_{kind}_repair_note", f"step2_repair_{kind}_candidate"]
    mine = F.col("reason_code") == only
    if report is None:
        values = [F.lit("step2_repair_not_run"), *[F.lit("")] * 3]
        return rows.select("*", *[F.when(mine, v).otherwise("").alias(n) for v, n in zip(values, names)])
    one = report.groupBy(F.col(key).alias("_id")).agg(F.min(F.struct(*[blank(c).alias(c) for c in ("status", "reason_code", "reason_detail", "candidate")])).alias("_h"))
    j = rows.join(one, rows[key] == F.col("_id"), "left")
    values = [F.coalesce("_h.status", F.lit("not_reported")), *[F.coalesce(f"_h.{c}", F.lit("")) for c in ("reason_code", "reason_detail", "candidate")]]
    return j.select(*rows.columns, *[F.when(mine, v).otherwise("").alias(n) for v, n in zip(values, names)])


def candidates(flagged: DataFrame) -> DataFrame:
    """Rows that a rule took (``classify.waterfall``) with the columns of CANDIDATE, ordered by book, file and reason for the file they are written to."""
    rows = flagged.where("reason_code is not null").withColumn("candidate_id", stable_id("batch", F.col("book_id"), F.col("data_id"), "reason_code", "matched_value"))
    own = [F.coalesce(c, F.lit("")).alias(c) if t == "string" else F.col(c) for c, t in rows.dtypes if c in CANDIDATE]
    have = set(rows.columns)
    return rows.select(*own, *[F.lit("").alias(c) for c in CANDIDATE if c not in have]).select(*CANDIDATE).orderBy("book_id", "data_id", "reason_code")


def manual_reviews(files: DataFrame, garbled: Column, titles: DataFrame | None = None, basenames: DataFrame | None = None, done: DataFrame | None = None, rules: RuleSet = RuleSet()) -> DataFrame:
    """One row per file and reason that a person has to look at, with the columns of MANUAL_REVIEW in their order.

    Reasons: a garbled title, a copy marker in the title, an unknown base name; a file may have all three. Files of ``done`` (``data_id``) are
    left out. titles (by ``book_id``) and basenames (by ``data_id``) are repair reports with ``status, reason_code, reason_detail, candidate``;
    their values stand only at the reason they belong to. Rows of one review_id are one; which of them stays is settled by their content.
    A null title or base name has no reason. An empty table gives an empty result.
    """
    left = files if done is None else files.join(done.select(F.col("data_id").alias("_done")).distinct(), F.col("data_id") == F.col("_done"), "left_anti")
    unknown = first_hit("file_basename", rules.unknown_markers)
    hit = lambda cond, code, value: F.when(cond, F.struct(F.lit(code).alias("reason_code"), F.lit(REASON_DETAILS[code]).alias("reason_detail"), value.alias("matched_value")))
    hits = F.array_compact(F.array(hit(F.coalesce(garbled, F.lit(False)), "title_mojibake", blank("title")), hit(first_hit("title", rules.copy_markers).isNotNull(), "title_copy", blank("title")), hit(unknown.isNotNull(), "file_basename_unknown", unknown)))
    base = [c for c in ("batch", "book_id", "data_id", "title", "file_basename", "ext", "bytes", "relative_path", "custom_column_1_value")]
    rows = left.select(*base, F.explode(hits).alias("_hit")).select(*base, "_hit.*")
    rows = rows.withColumn("review_id", stable_id("batch", F.col("book_id"), F.col("data_id"), "reason_code", "matched_value"))
    rest = [c for c in rows.columns if c != "review_id"]
    rows = rows.groupBy("review_id").agg(F.min(F.struct(*rest)).alias("_r")).select("review_id", "_r.*")
    rows = _handoff(_handoff(rows, titles, "book_id", "title", "title_copy"), basenames, "data_id", "basename", "file_basename_unknown")
    rows = rows.withColumn("recommended_action", F.lit("keep")).withColumn("partial_hint", partial_hint(F.when(F.col("reason_code") == "title_mojibake", F.col("title"))))
    empty = [c for c in MANUAL_REVIEW if c.startswith("human_")]
    return rows.select(*[F.lit("").alias(c) if c in empty else F.col(c) for c in MANUAL_REVIEW])


def encode_report(hits: DataFrame, books: DataFrame, ids: DataFrame, paths: DataFrame) -> DataFrame:
    """Garbled values with serial number, a row per value and book: ``serial, table, column, row_id, book_id, data_ids, value, chain, init_path, status, reason``.

    hits: as ``anomaly.scan`` gives them; books: ``table, row_id, book_id``; ids: ``book, data_ids``; paths: ``book, init_path``. A value of no book is
    kept with null book. Serial numbers follow (target, row, book).
    """
    j = hits.join(books, ["table", "row_id"], "left").join(ids.withColumnRenamed("book", "book_id"), "book_id", "left").join(paths.withColumnRenamed("book", "book_id"), "book_id", "left")
    rows = j.select("target", "table", "column", "row_id", "book_id", blank("data_ids").alias("data_ids"), "value", blank("chain").alias("chain"), blank("init_path").alias("init_path"), F.lit("delete_file").alias("status"), "reason")
    return with_surrogate(rows, "serial", ["target", "row_id", "book_id"]).drop("target")


def title_report(handoffs: DataFrame, ids: DataFrame) -> DataFrame:
    """Title repairs with the ids of the book's files: ``book_id, data_ids, original_title, title_candidate, status, reason_code``."""
    return handoffs.join(ids, handoffs["id"] == ids["book"], "left").select(F.col("id").alias("book_id"), blank("data_ids").alias("data_ids"), F.col("title").alias("original_title"), F.col("candidate").alias("title_candidate"), "status", "reason_code")


def basename_report(handoffs: DataFrame) -> DataFrame:
    """Base-name repairs: ``book_id, data_id, original_file_basename, format, file_basename_candidate, status, reason_code``."""
    return handoffs.select(F.col("book").alias("book_id"), F.col("id").alias("data_id"), F.col("name").alias("original_file_basename"), "format", F.col("candidate").alias("file_basename_candidate"), "status", "reason_code")


#: Facets of a comparison in the order of the report; sets are compared as sets, the rest by value.
FACETS = ("authors", "tags", "publisher", "languages", "rating", "series", "comments", "identifiers")
_HOW = {"publisher": compare.compare_values, "series": compare.compare_values, "comments": compare.compare_comments, "identifiers": compare.compare_maps}


def compare_facets(a: dict[str, Column], b: dict[str, Column]) -> list[Column]:
    """For each facet ``<facet>_compare``, its message, then ``metadata_compare``, the worst status, and ``delta``: whether the target lacks something."""
    both = {f: _HOW.get(f, compare.compare_sets)(a[f], b[f]) for f in FACETS if f in a}
    statuses = [s for s, _ in both.values()]
    return [*[m.alias(f"{f}_compare") for f, (_, m) in both.items()], compare.rollup(statuses).alias("metadata_compare"), compare.has_delta(statuses).alias("delta")]


#: Match -> reason of a scan row, without and with something to fill in.
SCAN_REASONS = {"file": "file_duplicate", "path": "target_path_exists_keep_target", "title_author": "suspected_duplicate_book", "title": "same_title_different_file", "none": "new_book_or_file"}
FILL_REASON = "file_duplicate_metadata_missing"


def _facets(lib: Library, book: str) -> DataFrame:
    p = compare.profiles(lib)
    names = {"publisher": F.array_join("publishers", ", "), "rating": F.col("ratings"), "series": F.array_join("series", ", "), "comments": F.col("comment")}
    facets = F.struct(*[names.get(f, F.col(f)).alias(f) for f in FACETS])
    return p.select(F.col("book").alias(book), facets.alias("facets"), compare.profile_text(["authors", "tags", "languages", "publishers", "series"]).alias("metadata"))


def _side(lib: Library, book: str, data: str) -> DataFrame:
    """All that a scan row says of one side, a row per file, as struct ``side``."""
    files = lib.book_files()
    first = compare.primary_author(lib).select(F.col("book").alias("_a"), F.col("author")) if {"authors", "books_authors_link"} <= set(lib) else None
    j = files if first is None else files.join(first, files["book_id"] == F.col("_a"), "left")
    if first is None:
        j = j.withColumn("author", F.lit(""))
    image = lambda t, key: row_image(lib[t], "_j").select(F.col("id").alias(key), F.col("_j").alias(f"{t}_record"))
    j = j.join(_facets(lib, "book_id"), "book_id", "left").join(image("books", "book_id"), "book_id", "left").join(image("data", "data_id"), "data_id", "left")
    side = F.struct(
        blank("title").alias("title"), blank("author").alias("author"), blank("book_path").alias("book_path"), blank("file_basename").alias("file_basename"), F.lower(blank("format")).alias("ext"), F.col("bytes"),
        relative_path("book_path", "file_basename", "format").alias("relative_path"), F.col("facets"), blank("metadata").alias("metadata"), "books_record", "data_record",
    )
    return j.select(F.col("book_id").alias(book), F.col("data_id").alias(data), side.alias("side"))


def scan_rows(matches: DataFrame, inc: Library, full: Library, batch: str) -> DataFrame:
    """The scan report: a row per incremental file with both sides' columns, the comparison of all facets, and what it recommends.

    matches: ``book_id, data_id, matched_by, target_book_id, target_data_id``, as ``compare.cascade`` gives them. Columns of the target are null where nothing
    matched. An equal file whose target lacks something is recommended to be filled in.
    """
    m = matches.select(F.col("book_id").alias("source_book_id"), F.col("data_id").alias("source_data_id"), "matched_by", "target_book_id", "target_data_id")
    s = _side(inc, "source_book_id", "source_data_id").drop("source_book_id").withColumnRenamed("side", "s")
    t = _side(full, "target_book_id", "target_data_id").drop("target_book_id").withColumnRenamed("side", "t")
    j = m.join(s, "source_data_id", "left").join(t, "target_data_id", "left")
    value = lambda side, f: F.coalesce(F.col(f"{side}.facets.{f}"), F.array().cast("array<string>")) if f in ("authors", "tags", "languages", "rating") else F.col(f"{side}.facets.{f}")
    a, b = ({f: value(side, f) for f in FACETS} for side in "st")
    j = j.select("*", *compare_facets(a, b))
    fill = (F.col("matched_by") == "file") & F.col("delta")
    reason = F.when(fill, FILL_REASON).otherwise(F.element_at(F.create_map(*[F.lit(x) for kv in SCAN_REASONS.items() for x in kv]), F.col("matched_by")))
    j = j.withColumn("reason_code", reason)
    text = lambda side, f: (F.length(blank(F.col(f"{side}.facets.comments"))).cast("string") if f == "comments" else F.array_join(value(side, f), "; ") if f in ("authors", "tags", "languages", "rating") else F.array_join(F.transform(F.map_entries(F.col(f"{side}.facets.identifiers")), lambda e: F.concat(e["key"], F.lit(":"), e["value"])), "; ") if f == "identifiers" else F.col(f"{side}.facets.{f}"))
    plain = ("title", "author", "book_path", "file_basename", "ext", "bytes", "relative_path", "metadata", "books_record", "data_record")
    columns = [x for c in plain for x in (F.col(f"s.{c}").alias(f"source_{c}"), F.col(f"t.{c}").alias(f"target_{c}"))]
    columns += [x for f in FACETS for x in (text("s", f).alias(f"source_{f}" + "_len" * (f == "comments")), text("t", f).alias(f"target_{f}" + "_len" * (f == "comments")))]
    key = sync_id(F.lit(batch), F.col("source_book_id"), F.col("source_data_id"), "reason_code", F.col("target_data_id"))
    return j.select(key.alias("sync_id"), F.lit(batch).alias("batch"), "reason_code", "source_book_id", "source_data_id", "target_book_id", "target_data_id", *columns, *[f"{f}_compare" for f in FACETS], "metadata_compare", compare.scan_action(delta=F.col("delta")).alias("recommended_action"), F.lit("").alias("human_decision"), F.lit("").alias("human_note"))


def child_rows(diff: DataFrame, scope: str, sync: DataFrame | None = None) -> DataFrame:
    """Rows of a child diff (``compare.diff_children``) for the report, one per side that has the child.

    ``sync_id, metadata_scope, metadata_key, pair_key, compare_status, compare_side, field_value, recommended_action, detail``; pair_key has ``-`` for a book that
    is missing. sync: ``book, side, sync_id`` ties books to scan rows.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("-"))
    pair = F.concat_ws(":", text("source_book"), text("target_book"), F.lit(scope), blank("child_key"))
    side = lambda name, book, value, there: F.when(there, F.struct(F.lit(name).alias("side"), F.col(book).cast("string").alias("book"), F.col(value).cast("string").alias("value")))
    sides = F.array_compact(F.array(side("incremental", "source_book", "source_value", F.col("status") != "target_only"), side("full", "target_book", "target_value", F.col("status") != "source_only")))
    rows = diff.select("*", pair.alias("pair_key"), F.explode(sides).alias("x"))
    action = F.when(F.col("status") == "source_only", "insert").when(F.col("status") == "conflict", "merge_metadata").otherwise("keep_target")
    out = rows.select(F.col("x.book").alias("_book"), F.col("x.side").alias("compare_side"), F.lit(scope).alias("metadata_scope"), blank("child_key").alias("metadata_key"), "pair_key", F.col("status").alias("compare_status"), blank("x.value").alias("field_value"), action.alias("recommended_action"), F.concat(F.lit(f"{scope}:book="), F.col("x.book"), F.lit(":"), F.col("status")).alias("detail"))
    if sync is not None:
        one = sync.groupBy(F.col("book").cast("string").alias("_b"), F.col("side").alias("_s")).agg(F.min("sync_id").alias("sync_id"))
        out = out.join(one, (F.col("_book") == F.col("_b")) & (F.col("compare_side") == F.col("_s")), "left").drop("_b", "_s")
    else:
        out = out.withColumn("sync_id", F.lit(None).cast("string"))
    return out.select(blank("sync_id").alias("sync_id"), *[c for c in out.columns if c not in ("_book", "sync_id")])


def merge_statuses(rows: DataFrame, results: DataFrame | None = None, force: bool = False) -> DataFrame:
    """Adds ``execute_status, verification_status`` to confirmed rows: ``sync_id, recommended_action, human_decision, manual`` (whether the row needs a person).

    manual_required without a decision, skipped where nothing is to be done, else by what the merge came to (``sync_id, data_status, file_status``): failed on a
    conflict or a missing file, success otherwise; no result at all is a failure.
    """
    decided = F.trim(blank("human_decision")) != ""
    action = F.when(decided, F.lower(F.trim(blank("human_decision")))).otherwise(F.trim(blank("recommended_action")))
    waiting = F.col("manual") & ~decided & F.lit(not force)
    idle = action.isin(*NOOP_ACTIONS)
    if results is None:
        bad, there = F.lit(False), F.lit(True)
        j = rows
    else:
        one = results.groupBy(F.col("sync_id").alias("_sync")).agg(F.bool_or((blank("data_status") == "conflict") | (blank("file_status") == "file_missing")).alias("_bad"))
        j = rows.join(one, rows["sync_id"] == F.col("_sync"), "left")
        bad, there = F.coalesce("_bad", F.lit(False)), F.col("_sync").isNotNull()
    status = F.when(waiting, "manual_required").when(idle, "skipped").when(~there | bad, "failed").otherwise("success")
    check = F.when(waiting, "not_verified").when(idle, "not_applicable").when(~there | bad, "not_verified").otherwise("verified")
    return j.select(*rows.columns, action.alias("action"), status.alias("execute_status"), check.alias("verification_status"))


def metadata_status(report: DataFrame) -> DataFrame:
    """``source_book, metadata_status, n_changed, n_conflicts`` of an upsert's report: conflict before updated before already_synced."""
    changed, clash = F.col("status").isin("inserted", "overwritten", "filled_missing"), F.col("status") == "conflict"
    n = report.groupBy("source_book").agg(F.count_if(changed).alias("n_changed"), F.count_if(clash).alias("n_conflicts"))
    return n.select("source_book", F.when(F.col("n_conflicts") > 0, "conflict").when(F.col("n_changed") > 0, "updated").otherwise("already_synced").alias("metadata_status"), "n_changed", "n_conflicts")


def stacked(parts: dict[str, DataFrame]) -> DataFrame:
    """Plans one below the other with the name each comes from in ``source`` and its place in ``source_order``; absent columns are null."""
    tagged = [d.withColumn("source", F.lit(n)).withColumn("source_order", F.lit(i)) for i, (n, d) in enumerate(parts.items())]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def summary(rows: DataFrame, column: str, order: str = "count") -> DataFrame:
    """One line ``name(count), name(count)``, by falling count or by name; blank values count as ``-``. One row per value, of which there are few."""
    n = rows.groupBy(F.when(F.trim(blank(column)) == "", "-").otherwise(blank(column)).alias("v")).agg(F.count("*").alias("n"))
    first = F.struct((-F.col("n") if order == "count" else F.lit(0)).alias("a"), "v", "n")
    return n.agg(F.array_join(F.transform(F.array_sort(F.collect_list(first)), lambda x: F.concat(x["v"], F.lit("("), x["n"].cast("string"), F.lit(")"))), ", ").alias("line"))


def examples(rows: DataFrame, by: list[str], order: list[str], n: int = 5) -> DataFrame:
    """The first n rows of each kind, for logs: only n rows a kind and task are ever sorted together."""
    from pyspark.sql import Window

    w = Window.partitionBy(*by).orderBy(*order)
    return rows.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= n).drop("_n")
