"""Round trips through legacy encodings for library titles: lossless restoring and hints for damaged text."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.functions.text import ORDINARY, blank, looks_native, replacement_damaged

#: Fixed values: (encoding taken, true encoding) in the order they are tried; the filler of a hint's gaps.
CHAINS = (("latin-1", "gb18030"), ("cp1250", "gb18030"), ("cp1252", "gb18030"), ("latin-1", "big5"))
FILLER = "◻"


def _han(s: str) -> int:
    return sum("一" <= c <= "鿿" for c in s)


def restore(text: str) -> tuple[str, str] | None:
    """(restored text, chain) if some round trip turns the text into mostly Chinese with more Chinese than before."""
    for wrong, true in CHAINS:
        try:
            new = text.encode(wrong).decode(true)
        except UnicodeError:
            continue
        if new and new != text and "�" not in new and 2 * _han(new) >= len(new) and _han(new) > _han(text):
            return new, f"{wrong}>{true}"
    return None


@F.pandas_udf(T.StructType([T.StructField("restored", T.StringType()), T.StructField("chain", T.StringType())]))
def _restore(values: pd.Series) -> pd.DataFrame:
    out = [restore(v) if v else None for v in values]
    return pd.DataFrame({"restored": [o[0] if o else None for o in out], "chain": [o[1] if o else None for o in out]})


def restore_text(c: Column | str) -> Column:
    """struct(restored, chain), both null where nothing is to restore.

    Only text with a non-ASCII character, without U+FFFD and without CJK ideographs can be restored: none of the encodings taken
    has an ideograph. All else is not sent to Python.
    """
    x = F.col(c) if isinstance(c, str) else c
    worth = x.rlike(r"[^\x00-\x7f]") & ~replacement_damaged(x) & ~x.rlike(r"[一-鿿]") & ~looks_native(x)
    return _restore(F.when(worth, x))


def is_mojibake(c: Column | str) -> Column:
    """Restorable, or damaged by U+FFFD."""
    return replacement_damaged(c) | restore_text(c)["restored"].isNotNull()


def _ordinary(c: str) -> bool:
    return any(a <= ord(c) <= b for a, b in ORDINARY)


def hint(text: str) -> str:
    """What is left of a damaged text: each character that is not ordinary as Chinese where its UTF-8 bytes are, gaps filled."""
    out = []
    for c in text:
        new = c
        if c == "�":
            new = FILLER
        elif not _ordinary(c):
            for _, true in CHAINS:
                try:
                    got = c.encode("utf-8").decode(true)
                except UnicodeError:
                    continue
                if got and got != c and _han(got) == len(got):
                    new = got
                    break
        out.append(new)
    return "".join(out)


@F.pandas_udf(T.StringType())
def _hint(values: pd.Series) -> pd.Series:
    return pd.Series([hint(v) if v else "" for v in values], dtype=object)


def partial_hint(c: Column | str) -> Column:
    """Hint for text with U+FFFD; empty for all other text."""
    return F.coalesce(_hint(F.when(replacement_damaged(c), blank(c))), F.lit(""))
