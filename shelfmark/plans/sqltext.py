"""Pieces of SQL that several checks share."""

from __future__ import annotations

#: The white space of functions.text.WS in the notation of RE2.
WS = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def strip(c: str) -> str:
    return f"regexp_replace({c}, '^{WS}+|{WS}+$', '', 'g')"


def normalize(c: str) -> str:
    return f"regexp_replace({strip(f'lower(coalesce({c}, {chr(39)}{chr(39)}))')}, '{WS}+', ' ', 'g')"


def normalize_title(c: str) -> str:
    return f"translate({normalize(c)}, '（）', '()')"


def first_hit(c: str, words: tuple[str, ...]) -> str:
    return "CASE " + " ".join(f"WHEN contains(coalesce({c}, ''), '{w}') THEN '{w}'" for w in words) + " END"
