"""One visual form per text (problem 3): characters that show nothing, other forms of a sign, look-alike letters.

The tables follow rules of the Unicode character database; only the look-alike letters are listed.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.session import cut

#: Letters of Greek, Cyrillic, Armenian, Cherokee and phonetic writing that look like a Latin one, written as pairs.
LOOKALIKE = (
    "ΑA ΒB ΕE ΖZ ΗH ΙI ΚK ΜM ΝN ΟO ΡP ΤT ΥY ΧX οo νv ιi υu ρp αa γy ϲc ϳj ϹC ͿJ АA ВB ЕE КK МM НH ОO РP СC ТT ХX УY ІI ЅS ЈJ ԌG ԜW ԚQ ҮY һh аa еe оo рp сc хx уy іi ѕs јj ԁd ԛq ԝw ӏl ѵv "
    "օo սu հh ոn ɑa ɡg ᎪA ᏴB ᏟC ᎠD ᎬE ᏀG ᎻH ᎫJ ᏦK ᏞL ᎷM ᏢP ᏒR ᏚS ᎢT ᏙV ᎳW ᏃZ"
)

#: Format characters that are drawn, so they stay.
DRAWN_FORMAT = {*range(0x600, 0x606), 0x6DD, 0x70F, 0x890, 0x891, 0x8E2, 0x110BD, 0x110CD, *range(0xFFF9, 0xFFFC), *range(0x13430, 0x13440)}
#: What shows nothing without being a format character: joiners, fillers, variation selectors.
UNDRAWN = {0x34F, 0x115F, 0x1160, 0x17B4, 0x17B5, *range(0x180B, 0x1810), 0x3164, 0xFFA0, *range(0xFE00, 0xFE10), *range(0xE0100, 0xE01F0)}


#: Anything but everyday characters, none of which shows nothing or has another form.
EVERYDAY = r"[^\x00-\x7f\xc0-\xff぀-ヿ一-鿿、。《》“”…]"

#: Where Unicode has format characters, blanks and compatibility forms (planes 0, 1, 2 and 14 in part).
FORMS_AT = (range(0xA0, 0x20000), range(0x2F800, 0x2FA20), range(0xE0000, 0xE1000))


@functools.cache
def invisible() -> frozenset[str]:
    return frozenset(chr(c) for c in chain(*FORMS_AT) if c in UNDRAWN or (unicodedata.category(chr(c)) == "Cf" and c not in DRAWN_FORMAT))


@functools.cache
def same_sign() -> dict[str, str]:
    """Other forms of one sign: width, font and no-break variants, canonical twins, radicals, ligatures, Roman numerals, blanks."""
    out: dict[str, str] = {}
    for c in chain(*FORMS_AT):
        ch = chr(c)
        if unicodedata.category(ch) == "Zs":
            out[ch] = " "
            continue
        tag, _, rest = unicodedata.decomposition(ch).partition(" ")
        if not tag:
            continue
        if tag in ("<wide>", "<narrow>", "<noBreak>", "<font>") or (not tag.startswith("<") and not rest) or (tag == "<compat>" and (0x2E80 <= c < 0x2FE0 or 0x2160 <= c < 0x2180 or 0xFB00 <= c < 0xFB07)) or c == 0xB5:
            out[ch] = unicodedata.normalize("NFKC", ch)
    return out | {"‐": "-", "‑": "-"}


@functools.cache
def lookalike() -> dict[str, str]:
    """The listed letters, and each that is one of them with accents: composed and decomposed spelling end in one form."""
    out = {p[0]: p[1] for p in LOOKALIKE.split()}
    for c in range(0xC0, 0x2000):
        base, marks = (d := unicodedata.normalize("NFD", chr(c)))[:1], d[1:]
        if marks and base in out:
            out[chr(c)] = unicodedata.normalize("NFC", out[base] + marks)
    return out


@functools.cache
def _tables() -> tuple[str, str, dict[str, str], str]:
    one, many = {}, {}
    # a look-alike is mapped after its other forms, so the full-width or mathematical letter ends at the same place
    for k, v in (same_sign() | lookalike()).items():
        v = "".join(lookalike().get(x, x) for x in v)
        (one if len(v) == 1 else many)[k] = v
    inv = sorted(map(ord, invisible()))
    spans, start = [], inv[0]
    for a, b in zip(inv, inv[1:] + [None]):
        if b != a + 1:
            spans.append((start, a))
            start = b
    cls = "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in spans)
    return "".join(one), "".join(one.values()), many, f"[{cls}]"


def skeleton(c: Column | str, letters: bool = True) -> Column:
    """The text without invisible characters and with one form per sign; letters: also look-alike letters as Latin ones.

    What a reader can see stays: case, accents, punctuation, the number of blanks. Composed and decomposed
    accents stay as they are and compare equal under the UNICODE collation. null stays null. Everyday text is passed through.
    """
    c = F.col(c) if isinstance(c, str) else c
    src, dst, many, inv = _tables()
    if not letters:
        like = lookalike()
        keep = [(a, b) for a, b in same_sign().items() if len(b) == 1]
        src, dst, many = "".join(a for a, _ in keep), "".join(b for _, b in keep), {a: b for a, b in same_sign().items() if len(b) > 1}
        assert not set(src) & {k for k in like if k not in same_sign()}
    x = F.translate(F.regexp_replace(c, inv, ""), src, dst)
    y = x
    for k, v in sorted(many.items()):
        y = F.replace(y, F.lit(k), F.lit(v))
    x = F.when(x.rlike("[" + "".join(sorted(many)) + "]"), y).otherwise(x)
    # ASCII is told by its length alone, without a look at the characters
    return F.when(F.octet_length(c) == F.length(c), c).when(c.rlike(EVERYDAY), x).otherwise(c)


@functools.cache
def _py_table(letters: bool) -> dict[int, str]:
    t = {ord(k): v for k, v in same_sign().items()} | {ord(k): "" for k in invisible()}
    return t | ({ord(k): v for k, v in lookalike().items()} if letters else {})


_OTHER = re.compile(EVERYDAY)


def canonical(text: str, letters: bool = False) -> str:
    """skeleton() of one text, composed; for code that is in Python already."""
    return text if text.isascii() or not _OTHER.search(text) else unicodedata.normalize("NFC", text.translate(_py_table(letters)))


@functools.cache
def to_cyrillic() -> dict[int, str]:
    return {ord(p[1]): p[0] for p in LOOKALIKE.split() if "Ѐ" <= p[0] < "԰"}


def visual_classes(df: DataFrame, column: str) -> DataFrame:
    """The distinct values of a column with the class of values that look alike.

    Returns ``value, n_rows, form, canonical, n_values``: n_rows counts the value's rows, form is its skeleton,
    canonical the one member that stands for the class, n_values the number of stored values in it. Values fall into one class
    if their skeletons are equal under the accent- and case-sensitive UNICODE collation. The canonical
    member is the one that equals its own skeleton, then the most frequent, then the least in code-point order.

    Rows are counted per stored value first, so a value on a third of all rows is one row from then on. null is
    no value and gets no row; the empty text and a text of invisible characters only form one class. An empty table gives
    an empty result; other columns are not read.
    """
    values = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n_rows"))
    values = values.withColumn("form", skeleton("value"))
    keyed = values.withColumn("_key", F.expr("collate(form, 'UNICODE')"))
    best = F.struct((F.col("form") != F.col("value")).alias("a"), (-F.col("n_rows")).alias("b"), F.col("value").alias("c"))
    classes = keyed.groupBy("_key").agg(F.min(best)["c"].alias("canonical"), F.count("*").alias("n_values"))
    return keyed.join(classes, "_key").select("value", "n_rows", "form", "canonical", "n_values")


def canonicalize(df: DataFrame, column: str, out: str = "canonical") -> DataFrame:
    """Adds the canonical member of each row's class; null stays null. All columns and rows of the input are kept."""
    c = visual_classes(df, column).where(F.col("value") != F.col("canonical")).select(F.col("value").alias("_v"), F.col("canonical").alias("_c"))
    return df.join(c, df[column] == c["_v"], "left").withColumn(out, F.coalesce("_c", F.col(column))).drop("_v", "_c")


def lookalike_pairs(df: DataFrame, key: str, column: str) -> DataFrame:
    """Pairs of keys whose values differ as stored but look alike; the smaller key first.

    Copies of one stored value make no pair with each other. The stored values of a class are paired first, each pair once; then rows
    join their value's pairs, first one side, then the other, so the work grows with the rows and the result, not with the square of a
    value's rows. Where even the result is too much, :func:`visual_classes` has one row per stored value with its class. A null key or value, and
    a key with itself, make no pair; repeated rows count once.
    """
    # a class with one stored value is the rule, so little is written here
    many = cut(visual_classes(df, column).where("n_values > 1").select("value", "canonical"))
    x, y = (many.select(F.col("value").alias(v), "canonical") for v in ("va", "vb"))
    pairs = x.join(y, "canonical").where("va < vb").select("va", "vb")
    rows = df.where(F.col(key).isNotNull()).select(F.col(key).alias("k"), F.col(column).alias("value")).join(many.select("value"), "value", "left_semi").distinct()
    one = pairs.join(rows.select(F.col("k").alias("ka"), F.col("value").alias("va")), "va").select("ka", "vb")
    both = one.join(rows.select(F.col("k").alias("kb"), F.col("value").alias("vb")), "vb").where("ka <> kb")
    return both.select(F.least("ka", "kb").alias(f"{key}_a"), F.greatest("ka", "kb").alias(f"{key}_b")).distinct()
