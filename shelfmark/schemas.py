"""Schemas of library relations and reports."""

from __future__ import annotations

from pyspark.sql import types as T

#: Relations of a library: name -> DDL; further columns are kept as they are.
LIBRARY = {
    "books": "id long, title string, sort string, author_sort string, path string",
    "data": "id long, book long, format string, uncompressed_size long, name string",
    "authors": "id long, name string, sort string",
    "series": "id long, name string, sort string",
    "publishers": "id long, name string, sort string",
    "tags": "id long, name string",
    "languages": "id long, lang_code string",
    "ratings": "id long, rating int",
    "comments": "id long, book long, text string",
    "identifiers": "id long, book long, type string, val string",
} | {f"books_{t}_link": f"id long, book long, {k} long" for t, k in (("authors", "author"), ("tags", "tag"), ("languages", "lang_code"), ("ratings", "rating"), ("publishers", "publisher"), ("series", "series"))}

#: Reports: columns in their order; all are text in files.
AUTO_CANDIDATE = ["batch", "book_id", "data_id", "title", "file_basename", "ext", "bytes", "relative_path", "reason_code", "reason_detail", "matched_value", "recommended_action", "custom_column_1_value"]
CANDIDATE = ["candidate_id", *AUTO_CANDIDATE]
MANUAL_REVIEW = [
    "review_id", "batch", "book_id", "data_id", "title", "file_basename", "ext", "bytes", "relative_path", "reason_code", "reason_detail", "matched_value", "recommended_action", "custom_column_1_value",
    *[f"step2_repair_title_{c}" for c in ("repair_status", "repair_reason", "repair_note", "candidate")], *[f"step2_repair_basename_{c}" for c in ("repair_status", "repair_reason", "repair_note", "candidate")],
    "partial_hint", "human_decision", "human_title", "human_file_basename", "human_note",
]
ENCODE_REPAIR = ["table", "column", "row_id", "book_id", "value", "repaired", "init_path", "status"]
TITLE_REPAIR = ["book_id", "original_title", "title_candidate", "status", "reason_code", "reason_detail", "init_path"]
BASENAME_REPAIR = ["book_id", "data_id", "original_file_basename", "format", "file_basename_candidate", "status", "reason_code", "reason_detail", "init_path"]

#: Dictionaries with their link tables: dictionary -> (value column, link table, link column, several values per book).
LINKS = {
    "authors": ("name", "books_authors_link", "author", True),
    "tags": ("name", "books_tags_link", "tag", True),
    "languages": ("lang_code", "books_languages_link", "lang_code", True),
    "ratings": ("rating", "books_ratings_link", "rating", False),
    "publishers": ("name", "books_publishers_link", "publisher", False),
    "series": ("name", "books_series_link", "series", False),
}


def library_schema(name: str) -> T.StructType:
    return T.StructType.fromDDL(LIBRARY[name])
