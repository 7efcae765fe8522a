"""Column expressions for text: normalising, splitting and measuring, all inside whole-stage codegen.

A null input gives null unless a function says otherwise; callers that follow the "null equals empty"
rule of the record schemas wrap the column in :func:`blank`.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The white space that Python's str.strip() takes off (Java's \s knows only ASCII).
WS = r"\t-\r\x1c-\x20\x85\xa0  -     　"

#: Ranges of characters that ordinary titles have.
ORDINARY = (
    (0x20, 0x7E), (0x2010, 0x203B), (0x2044, 0x205E), (0x2160, 0x2183), (0x2600, 0x27BF), (0x3000, 0x303F), (0x3040, 0x30FF), (0x4E00, 0x9FFF), (0xFF01, 0xFF5E), (0xFF5F, 0xFF60), (0xFFE0, 0xFFE6),
)

#: Everything that is neither letter nor digit.
NOT_ALNUM = r"[^\p{L}\p{N}]+"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank(c: Column | str) -> Column:
    """null becomes the empty text."""
    return F.coalesce(col(c).cast("string"), F.lit(""))


def strip(c: Column | str) -> Column:
    """Takes Unicode white space off both ends."""
    return F.regexp_replace(col(c), rf"^[{WS}]+|[{WS}]+$", "")


def squeeze(c: Column | str) -> Column:
    """strip() and each inner run of white space as one blank."""
    return F.regexp_replace(strip(c), rf"[{WS}]+", " ")


def normalize(c: Column | str) -> Column:
    """Lower case, squeezed: the key of plain values. null counts as empty."""
    return squeeze(F.lower(blank(c)))


def normalize_title(c: Column | str) -> Column:
    """The title key: normalize() with full-width parentheses as ASCII ones. null counts as empty."""
    return F.translate(normalize(c), "（）", "()")


def fold_case(c: Column | str) -> Column:
    """Case-insensitive form, in which a sharp s equals SS (upper() maps single characters only)."""
    return F.replace(F.lower(F.upper(col(c))), F.lit("ß"), F.lit("ss"))


def letters(c: Column | str) -> Column:
    """Only letters and digits, case folded."""
    return F.regexp_replace(fold_case(c), NOT_ALNUM, "")


def ascii_lower(c: Column | str) -> Column:
    """Folds A-Z only, as a NOCASE comparison of ASCII text does."""
    return F.translate(col(c), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sync_key(c: Column | str) -> Column:
    """Stripped and lower case without squeezing; null gives the text 'none'."""
    return F.coalesce(F.lower(strip(col(c).cast("string"))), F.lit("none"))


def book_key(title: Column | str, author: Column | str) -> Column:
    """title|author, or the title alone where the author is blank."""
    t, a = normalize(title), normalize(author)
    return F.when(a == "", t).otherwise(F.concat(t, F.lit("|"), a))


def file_name(path: Column | str) -> Column:
    """Last component of a path with either kind of slash."""
    return F.regexp_extract(blank(path), r"([^/\\]*)\z", 1)


def path_stem(path: Column | str) -> Column:
    """The stem of a usable file path, else null: one with a stem, a dot and a suffix. A leading dot starts no suffix."""
    name = strip(file_name(path))
    stem = strip(F.regexp_extract(name, r"(?s)^(.+)\.[^.]+\z", 1))
    return F.when(stem != "", stem)


def path_suffix(path: Column | str) -> Column:
    """Lower-case suffix of a usable file path, else null."""
    name = strip(file_name(path))
    suffix = F.lower(F.regexp_extract(name, r"(?s)^.+\.([^.]+)\z", 1))
    return F.when(suffix != "", suffix)


def cjk_ratio(c: Column | str) -> Column:
    """Share of code points in U+4E00-U+9FFF; 0.0 for empty or null."""
    x = blank(c)
    return F.when(x == "", F.lit(0.0)).otherwise(F.length(F.regexp_replace(x, r"[^一-鿿]", "")) / F.length(x))


def replacement_damaged(c: Column | str) -> Column:
    """Holds U+FFFD."""
    return blank(c).contains("�")


def looks_native(c: Column | str) -> Column:
    """Undamaged, at least half CJK, none of the rare extension-A or compatibility ideographs."""
    x = blank(c)
    return ~replacement_damaged(x) & (cjk_ratio(x) >= 0.5) & ~x.rlike(r"[㐀-䶿豈-﫿]")


def ordinary_only(c: Column | str) -> Column:
    """Only characters that ordinary titles have (ORDINARY); empty and null too."""
    return blank(c).rlike("^[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in ORDINARY) + "]*\\z")


def sql_quote(c: Column | str) -> Column:
    """An SQL text literal."""
    return F.concat(F.lit("'"), F.replace(blank(c), F.lit("'"), F.lit("''")), F.lit("'"))


def bat_quote(c: Column | str) -> Column:
    """Text for a batch file: the shell's own signs are escaped, all else stays; whoever writes it puts the quotes."""
    return F.regexp_replace(F.replace(blank(c), F.lit("%"), F.lit("%%")), r"([\^&|<>])", r"^$1")


def to_int(c: Column | str, default: int = 0) -> Column:
    """An integer in a text, or the default."""
    return F.coalesce(col(c).cast("string").try_cast("bigint"), F.lit(default).cast("bigint"))


def date_key(c: Column | str) -> Column:
    """YYYY-MM-DD from a snapshot's name, metadata-YYYYMMDD with any tags before the ending; else null."""
    m = F.regexp_extract(blank(c), r"metadata-(?:full-)?(\d{8})(?:\.[A-Za-z0-9_]+)*\.\w+$", 1)
    return F.when(m != "", F.concat_ws("-", m.substr(1, 4), m.substr(5, 2), m.substr(7, 2)))


def human_size(c: Column | str) -> Column:
    """Bytes as B, KB, MB or GB with one decimal."""
    x = col(c).cast("double")
    return (
        F.when(x < 1024, F.concat(col(c).cast("string"), F.lit("B")))
        .when(x < 1024**2, F.format_string("%.1fKB", x / 1024))
        .when(x < 1024**3, F.format_string("%.1fMB", x / 1024**2))
        .otherwise(F.format_string("%.1fGB", x / 1024**3))
    )
