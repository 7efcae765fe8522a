"""Text garbled by a wrong decoding (problem 6): round-trip repair under a cost learned from the corpus.

A suspicious piece of text is encoded again under each legacy encoding that may have been taken for the true one, strictly decoded
as each intended encoding, and this again for nested layers. A repair is accepted when the cost of the text, in bits under
character statistics of the whole corpus, drops by more than the repair itself costs.
"""

from __future__ import annotations

import codecs
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm.forms import canonical, to_cyrillic

#: First code point of each class of characters that go together in text; upper and lower case share one.
CLASS_STARTS = [
    (0x0, 1), (0x20, 2), (0x21, 3), (0x30, 4), (0x3A, 3), (0x41, 5), (0x5B, 3), (0x61, 5), (0x7B, 3), (0x7F, 7), (0xA0, 8), (0xC0, 9), (0xD7, 8), (0xD8, 9),
    (0xF7, 8), (0xF8, 9), (0x100, 11), (0x250, 12), (0x300, 13), (0x370, 14), (0x400, 15), (0x460, 17), (0x590, 18), (0xE00, 19), (0x1E00, 11), (0x1F00, 14), (0x2000, 20), (0x2070, 21),
    (0x2500, 22), (0x25A0, 23), (0x2E80, 24), (0x3000, 25), (0x3040, 26), (0x30A0, 27), (0x3100, 28), (0x3400, 29), (0x4E00, 30), (0xA000, 18), (0xAC00, 31), (0xD800, 32),
    (0xF900, 24), (0xFB00, 33), (0xFF00, 34), (0xFF61, 35), (0xFFA0, 33), (0xFFF0, 36), (0x10000, 37),
]
CLASSES = 38
TOP = 0x110000

#: Encodings a text may have been taken for, one byte a character (bytes they lack stand for themselves) ...
TAKEN_FOR = ("latin-1", "cp1252", "cp1250", "cp1251", "cp437", "cp850", "cp866", "koi8-r", "mac-roman", "mac-cyrillic")
#: ... or several; and the encodings it may be in.
TAKEN_FOR_WIDE = ("gbk", "big5", "big5hkscs", "cp932", "cp949", "euc_jp")
INTENDED_WIDE = ("utf-8", "gb18030", "big5", "cp932", "euc_jp", "cp949")
INTENDED = ("cp1251", "koi8-r", "cp866", "cp1252", "cp1250", "cp850")
#: Tables of one family differ in few signs, which makes no garbling.
KIN = {("gbk", "gb18030"), ("big5hkscs", "big5")}
#: Further bits for naming an encoding that is seldom mistaken.
SELDOM = {"mac-cyrillic": 6.0, "mac-roman": 3.0, "cp949": 4.0}

#: Bits that naming a pair of encodings costs, bits of gain beyond which a repair is accepted, and bits of another reading (look-alike letters).
PAIR_BITS, GAIN_BITS, READING_BITS = 7.0, 4.0, 1.0
#: Readings of a layer that are decoded further, the cheapest ones; bits by which such a reading may be dearer than the best so far, as
#: a layer between need not pay by itself; and layers in a row that may pass without a new best reading.
BEAM, BETWEEN_BITS, PATIENCE = 3, 14.0, 1
#: Bits against each sure sign of garbling (see _STILL) that a repaired text still has: a corpus with garbled text makes such text look cheap.
TELL_BITS = 6.0
NAMING = {(n, r): PAIR_BITS + SELDOM.get(n, 0.0) + SELDOM.get(r, 0.0) for n in TAKEN_FOR + TAKEN_FOR_WIDE for r in INTENDED_WIDE + INTENDED}
#: Further bits for a repair of one character by one other: one byte proves little.
LONE_BITS = 10.0
#: A piece is suspicious with a non-ASCII character of so many bits, so many on average, or a tell.
ODD_BITS, MEAN_BITS = 13.0, 10.0

_PIECES = regex.compile(r"[^/;\r\n]+")
_INNER = regex.compile(r"[^\\]+")
#: Parts joined by a backslash that may be the second byte of a character: it follows a character that is not ASCII.
_JOINED = regex.compile(r"[^\\]*(?:(?<=[^\x00-\x7f])\\[^\\]*)+")
_WORDS = regex.compile(r"\S+")
#: Tells: controls, signs and frames, letters with marks side by side, a Cyrillic capital after a small letter.
_TELL = regex.compile(r"[\x80-\xbf⁰-⓿─-▟�]|[À-ɏ]{2}|[а-ё][А-Я]")
_STILL = regex.compile(r"[\x80-\x9f─-▟\p{Co}]|[À-ɏ]{3}|\p{Cyrillic}(?=\p{Latin})|\p{Latin}(?=\p{Cyrillic})")
_WIDE = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Hangul}\p{Bopomofo}\p{Co}　-〿＀-￯]")
_RUNS = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}々-〟ー]+|[^\p{Han}\p{Hiragana}\p{Katakana}々-〟ー]+")


@functools.cache
def _classes() -> np.ndarray:
    out = np.zeros(TOP, np.uint8)
    for (a, k), b in zip(CLASS_STARTS, [s for s, _ in CLASS_STARTS[1:]] + [TOP]):
        out[a:b] = k
    return out


@functools.cache
def _fold() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-case code point of each; which are lower and which upper case."""
    fold = np.arange(TOP, dtype=np.uint32)
    lower, upper = np.zeros(TOP, bool), np.zeros(TOP, bool)
    for c in range(0x20000):
        ch = chr(c)
        low = ch.lower()
        if len(low) == 1 and low != ch:
            fold[c], upper[c] = ord(low), True
        elif ch.upper() != ch:
            lower[c] = True
    return fold, lower, upper


def _codes(s: str) -> np.ndarray:
    return np.frombuffer(s.encode("utf-32-le", "surrogatepass"), np.uint32)


class CharModel:
    """Costs in bits: the class of a character after that of the one before, the folded character in its class, and a capital
    after a small letter."""

    def __init__(self, chars: dict[int, int], steps: dict[int, int]) -> None:
        cls = _classes()
        e = np.zeros(TOP)
        e[list(chars)] = list(chars.values())
        t = np.zeros(CLASSES * CLASSES)
        t[list(steps)] = list(steps.values())
        t = t.reshape(CLASSES, CLASSES)
        n, size = np.bincount(cls, weights=e, minlength=CLASSES), np.bincount(cls, minlength=CLASSES)
        self.char = -np.log2((e + 0.02) / (n[cls] + 0.02 * size[cls])).astype(np.float32)
        self.step = -np.log2((t + 0.5) / (t.sum(1, keepdims=True) + 0.5 * CLASSES)).astype(np.float32)

    @staticmethod
    def count(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Counts of folded characters and of class steps; texts are joined by line ends."""
        a = _codes("\n".join(texts))
        a = _fold()[0][a]
        c = _classes()[a].astype(np.int64)
        return np.bincount(a, minlength=TOP), np.bincount(c[:-1] * CLASSES + c[1:], minlength=CLASSES * CLASSES)

    def _bits(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        raw = _codes("\n" + "\n".join(texts) + "\n")
        fold, lower, upper = _fold()
        a = fold[raw]
        c = _classes()[a]
        x = self.char[a]
        x[1:] += self.step[c[:-1], c[1:]] + 2.0 * (lower[raw[:-1]] & upper[raw[1:]])
        x[0] = 0
        return raw, x, np.flatnonzero(raw == 10)

    def costs(self, texts: list[str]) -> np.ndarray:
        """Bits of each text; no text may hold a line end."""
        if not texts:
            return np.zeros(0)
        _, x, ends = self._bits(texts)
        total = np.concatenate([[0], np.cumsum(x, dtype=np.float64)])
        return total[ends[1:]] - total[ends[:-1] + 1]

    def odd(self, texts: list[str]) -> np.ndarray:
        """Which texts are suspicious by the bits of their non-ASCII characters."""
        raw, x, ends = self._bits(texts)
        x[raw < 128] = 0
        n = np.add.reduceat((raw >= 128).astype(np.float32), ends[:-1])
        return (np.maximum.reduceat(x, ends[:-1]) > ODD_BITS) | (np.add.reduceat(x, ends[:-1]) > MEAN_BITS * n)


@functools.cache
def _charmap(name: str) -> object:
    table = []
    for b in range(256):
        try:
            table.append(bytes([b]).decode(name))
        except UnicodeDecodeError:
            table.append(chr(b))
    return codecs.charmap_build("".join(table))


def _bytes(s: str) -> Iterator[tuple[str, bytes]]:
    for n in TAKEN_FOR:
        try:
            yield n, codecs.charmap_encode(s, "strict", _charmap(n))[0]
        except UnicodeEncodeError:
            pass
    for n in TAKEN_FOR_WIDE if _WIDE.search(s) else ():
        try:
            yield n, s.encode(n)
        except UnicodeEncodeError:
            pass


def _readings(s: str) -> dict[str, tuple[str, str]]:
    """Every other text that a round trip gives, with its first pair of encodings."""
    out: dict[str, tuple[str, str]] = {}
    seen: set[bytes] = set()  # tables that agree on the text give the same readings, which bear the first one's name
    for n, b in _bytes(s):
        if b.isascii() or b in seen:
            continue
        seen.add(b)
        for r in INTENDED_WIDE + INTENDED:
            if r != n and (n, r) not in KIN:
                try:
                    t = b.decode(r)
                except UnicodeDecodeError:
                    continue
                if t != s and "\n" not in t and "\r" not in t:
                    out.setdefault(t, (n, r))
    return out


def _base(model: CharModel, units: list[str]) -> np.ndarray:
    """Cost of each text under its best reading without any decoding: as it is, in one visual form, with look-alike letters."""
    m = model.costs(units)
    m = np.minimum(m, model.costs([canonical(u) for u in units]))
    m = np.minimum(m, model.costs([canonical(u, letters=True) for u in units]) + READING_BITS)
    return np.minimum(m, model.costs([canonical(u).translate(to_cyrillic()) for u in units]) + READING_BITS)


def _repair(model: CharModel, pieces: list[tuple[str, str, str]]) -> list[tuple[float, str, tuple]]:
    """For (before, piece, after): gain in bits, the repaired whole, the chain of pairs; gain 0 if nothing is better.

    Layer by layer the cheapest readings are decoded again, those too that do not pay by themselves, until the layers bring nothing better.
    """
    whole = [a + p + z for a, p, z in pieces]
    base = _base(model, whole)
    res: list[tuple[float, str, tuple]] = [(0.0, w, ()) for w in whole]
    #: piece -> its readings to decode further, as (text, bits paid for naming, chain)
    front: dict[int, list[tuple[str, float, tuple]]] = {i: [(p, 0.0, ())] for i, (_, p, _) in enumerate(pieces)}
    seen: dict[int, set[str]] = {i: {p} for i, (_, p, _) in enumerate(pieces)}
    stale = dict.fromkeys(front, 0)
    while front:
        texts, own, paid, chains = [], [], [], []
        for i, states in front.items():
            for now, cost, chain in states:
                lone = LONE_BITS if sum(x > "\x7f" for x in now) == 1 else 0.0
                for t, c in _readings(now).items():
                    if t not in seen[i]:
                        seen[i].add(t)
                        texts.append(t)
                        own.append(i)
                        paid.append(cost + NAMING[c] + (lone if c[1] in INTENDED else 0.0))
                        chains.append((*chain, c))
        if not texts:
            break
        cost = model.costs([pieces[i][0] + t + pieces[i][2] for i, t in zip(own, texts)]) + np.array(paid)
        who = np.array(own)
        order = np.lexsort((cost, who))
        starts = np.flatnonzero(np.r_[True, who[order][1:] != who[order][:-1]])
        front = {}
        for a, b in zip(starts, np.append(starts[1:], len(order))):
            i = own[order[a]]
            cheap = order[a : min(b, a + BEAM)]
            final = [cost[j] + TELL_BITS * len(_STILL.findall(texts[j])) for j in cheap]
            k = int(np.argmin(final))
            if base[i] - final[k] > res[i][0]:
                j = cheap[k]
                res[i] = (float(base[i] - final[k]), pieces[i][0] + texts[j] + pieces[i][2], chains[j])
                stale[i] = 0
            else:
                stale[i] += 1
            near = [j for j in cheap if cost[j] < base[i] - res[i][0] + BETWEEN_BITS]
            if near and stale[i] <= PATIENCE:
                front[i] = [(texts[j], paid[j], chains[j]) for j in near]
    return res


def _cut(value: str) -> tuple[list[str], dict[str, list[str]]]:
    """The pieces to judge, and the joined ones (see _JOINED) with the pieces each is made of."""
    out, joined = [], {}
    for p in _PIECES.findall(value):
        if "\\" not in p:
            out.append(p)
            continue
        out += _INNER.findall(p)
        for m in _JOINED.finditer(p):
            joined[m[0]] = [x for x in _INNER.findall(m[0]) if not x.isascii()]
    return [p for p in out if not p.isascii()], joined


def _suspicious(model: CharModel, texts: list[str]) -> list[bool]:
    """By the better of two readings, with and without look-alike letters."""
    if not texts:
        return []
    plain = [canonical(t) or " " for t in texts]
    bits = model.odd(plain) & model.odd([canonical(t, letters=True) or " " for t in plain])
    return [bool(b or _TELL.search(t)) for b, t in zip(bits, plain)]


def repair(model: CharModel, values: list[str]) -> list[tuple[str | None, str, float] | None]:
    """For each text: None if sound, else (restored text, how, gain in bits).

    A text with U+FFFD lost bytes in a decoding: it is found, but cannot be restored (null, ``lost``). Pieces between slashes,
    semicolons and line ends are judged one by one, whatever their length, first whole, then by words and by runs of one script. A backslash may
    part two pieces or be the second byte of a character; the reading that gains more counts.
    """
    cuts = [([], {}) if "�" in v else _cut(v) for v in values]
    units = list(dict.fromkeys(p for c, j in cuts for p in (*c, *j)))
    units = [u for u, odd in zip(units, _suspicious(model, units)) if odd]
    fixed = dict(zip(units, _repair(model, [("", u, "") for u in units]))) if units else {}
    parts: dict[tuple[str, str, str], str] = {}
    for u in units:
        if fixed[u][0] < GAIN_BITS:
            for rx in (_WORDS, _RUNS):
                for m in rx.finditer(u):
                    if m.end() - m.start() < len(u) and not m[0].isascii():
                        parts[u[: m.start()], m[0], u[m.end() :]] = u
    tried = [p for p, odd in zip(parts, _suspicious(model, [p[1] for p in parts])) if odd]
    for p, r in zip(tried, _repair(model, tried) if tried else ()):
        if r[0] > fixed[parts[p]][0]:
            fixed[parts[p]] = r
    out: list[tuple[str | None, str, float] | None] = []
    for v, (c, joined) in zip(values, cuts):
        if "�" in v:
            out.append((None, "lost", 0.0))
            continue
        gain, text, how = 0.0, v, []
        won = lambda p: g if (g := fixed.get(p, (0.0,))[0]) >= GAIN_BITS else 0.0
        whole = [j for j, parts_ in joined.items() if won(j) > sum(map(won, parts_))]
        inside = {x for j in whole for x in joined[j]}
        for p in dict.fromkeys([*whole, *(x for x in c if x not in inside)]):
            g, t, chain = fixed.get(p, (0.0, p, ()))
            if g >= GAIN_BITS:
                gain, text = gain + g, text.replace(p, t)
                how.append("+".join(f"{a}>{b}" for a, b in chain))
        out.append((text, ",".join(dict.fromkeys(how)), gain) if how else None)
    return out


COUNTS = "kind int, code int, n bigint"


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    chars, steps = np.zeros(TOP, np.int64), np.zeros(CLASSES * CLASSES, np.int64)
    for b in batches:
        texts = [t for t in b.column(0).to_pylist() if t and "�" not in t and not _valid_utf8(t)]
        for k in range(0, len(texts), 2000):
            c, s = CharModel.count(texts[k : k + 2000])
            chars += c
            steps += s
    for kind, a in ((0, chars), (1, steps)):
        at = np.flatnonzero(a)
        yield pa.record_batch([pa.array(np.full(len(at), kind, np.int32)), pa.array(at.astype(np.int32)), pa.array(a[at])], names=["kind", "code", "n"])


def _valid_utf8(t: str) -> bool:
    """Its bytes under a common one-byte encoding are UTF-8: sound text is so only if it is ASCII."""
    if t.isascii() or not _TELL.search(t):
        return False
    for n in ("cp1252", "cp437", "cp1251"):
        try:
            codecs.charmap_encode(t, "strict", _charmap(n))[0].decode("utf-8")
            return True
        except UnicodeError:
            pass
    return False


def learn(spark: SparkSession, texts: DataFrame) -> CharModel:
    """Character statistics over all rows of a one-column table. Texts that are garbled beyond doubt are not counted.

    The counts are summed in Spark; at most one row per Unicode code point reaches the driver, whatever the corpus.
    """
    rows = texts.mapInArrow(_count_batches, COUNTS).groupBy("kind", "code").agg(F.sum("n").alias("n")).collect()
    return CharModel({r.code: r.n for r in rows if r.kind == 0}, {r.code: r.n for r in rows if r.kind == 1})


def find_garbled(df: DataFrame, key: str, fields: list[str], model: CharModel | None = None) -> DataFrame:
    """The garbled values of the named columns: ``<key>, field, value, restored, how, gain_bits``.

    ``how`` lists the pairs of encodings (taken for > intended), nested layers joined by +; ``lost`` marks text with replacement
    characters, which cannot be restored (null). Without a model one is learned from the same columns. Null, empty and ASCII
    values are sound. Row by row, without a shuffle; repeated values give repeated rows. The key may be null.
    """
    spark = df.sparkSession
    long = df.select(F.col(key), F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in fields])).alias("x")).select(key, "x.field", "x.value").where(F.col("value").rlike(r"[^\x00-\x7f]"))
    model = model or learn(spark, stacked(df, fields))
    shared = spark.sparkContext.broadcast(model)  # bounded by the number of code points
    key_type = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, tuple[str | None, str, float] | None] = {}
        for b in batches:
            col = b.column(2).to_pylist()
            new = list(dict.fromkeys(v for v in col if v not in seen))
            if len(seen) > 200_000:
                seen.clear()
                new = list(dict.fromkeys(col))
            for i in range(0, len(new), 1000):
                part = new[i : i + 1000]
                seen.update(zip(part, repair(shared.value, part)))
            hit = [i for i, v in enumerate(col) if seen[v]]
            got = [seen[col[i]] for i in hit]
            yield pa.record_batch(
                [*(b.column(j).take(pa.array(hit, pa.int64())) for j in range(3)), *(pa.array([g[j] for g in got], t) for j, t in ((0, pa.string()), (1, pa.string()), (2, pa.float64())))],
                names=[key, "field", "value", "restored", "how", "gain_bits"],
            )

    return long.mapInArrow(run, f"`{key}` {key_type}, field string, value string, restored string, how string, gain_bits double")


def stacked(df: DataFrame, fields: list[str]) -> DataFrame:
    """The non-null values of several columns as one column."""
    return df.select(F.explode(F.array(*[F.col(f) for f in fields])).alias("text")).where("text is not null")
