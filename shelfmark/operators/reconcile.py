"""Differences between two copies of data (problem 4): set reconciliation by characteristic polynomials.

Each row becomes one element of the field of 2^61 - 1 elements, a hash of its key and compared values, and rows fall into buckets by a hash of
their key. Of a bucket each side sends only a sketch: the number of its elements and the values of its characteristic polynomial, the product
of (z - x), at sample points. Where the sketches differ, the ratio of the two sides' values is a rational function whose zeros and poles are the
differing rows; it is interpolated under a bound on their number that doubles until further points confirm it. Buckets that need more points than
their sketch has send a longer one. Each side gets its polynomial back and finds the rows that are roots; only these are fetched and compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.session import cut
from shelfmark.functions.text import blank, strip

P = np.uint64((1 << 61) - 1)
_31, _30 = np.uint64((1 << 31) - 1), np.uint64((1 << 30) - 1)
#: Rows hash below 2^60; sample points lie above, so that no factor is zero.
HASH_BITS = 60
#: Rows of both sides per bucket, aimed at; first bound on the differences; points that confirm.
BUCKET, FIRST_BOUND, CONFIRM = 64, 8, 2
#: The bound that a first sketch allows, and by how much one grows that did not suffice.
SKETCH, GROWTH = 16, 8


def _reduce(x: np.ndarray) -> np.ndarray:
    x = (x >> np.uint64(61)) + (x & P)
    return np.where(x >= P, x - P, x)


def mul(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Product in the field, in halves of 31 bits."""
    ah, al, bh, bl = a >> np.uint64(31), a & _31, b >> np.uint64(31), b & _31
    mid = _reduce(ah * bl + al * bh)
    return _reduce(_reduce(ah * bh * np.uint64(2)) + (mid >> np.uint64(30)) + ((mid & _30) << np.uint64(31)) + _reduce(al * bl))


def sub(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.where(a >= b, a - b, a + P - b)


# Polynomials are lists of coefficients, lowest first.
_M = int(P)


def inverse(a: int) -> int:
    return pow(a, -1, _M)


def points(n: int) -> np.ndarray:
    return np.arange(n, dtype=np.uint64) + np.uint64(1 << HASH_BITS)


def _products(m: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Column-wise field products of consecutive runs of rows."""
    while len(lengths) and lengths.max() > 1:
        start = np.append(0, np.cumsum(lengths)[:-1])
        place = np.arange(len(m)) - np.repeat(start, lengths)
        even = np.flatnonzero(place % 2 == 0)
        paired = np.flatnonzero(place[even] + 1 < np.repeat(lengths, lengths)[even])
        out = m[even]
        out[paired] = mul(out[paired], m[even[paired] + 1])
        m, lengths = out, (lengths + 1) // 2
    return m


def characteristic(elements: np.ndarray, z: np.ndarray) -> np.ndarray:
    """Value of the product of (z - x) over all elements at each point."""
    if not len(elements):
        return np.ones(len(z), np.uint64)
    return _products(sub(z[None, :], elements.astype(np.uint64)[:, None]), np.array([len(elements)]))[0]


def _solve(a: list[list[int]]) -> list[int] | None:
    """A solution of the augmented system, free unknowns zero; None if there is none. Small systems: plain integers are the fastest."""
    cols = len(a[0]) - 1
    pivots, r = [], 0
    for c in range(cols):
        k = next((i for i in range(r, len(a)) if a[i][c]), None)
        if k is None:
            continue
        a[r], a[k] = a[k], a[r]
        f = inverse(a[r][c])
        top = a[r] = [x * f % _M for x in a[r]]
        for i, row in enumerate(a):
            if i != r and (f := row[c]):
                a[i] = [(x - f * y) % _M for x, y in zip(row, top)]
        pivots.append(c)
        r += 1
        if r == len(a):
            break
    if any(row[cols] for row in a[r:]):
        return None
    x = [0] * cols
    for c, row in zip(pivots, a):
        x[c] = row[cols]
    return x


def _value(coefficients: list[int], x: int) -> int:
    """A polynomial, lowest coefficient first, at x."""
    y = 0
    for c in reversed(coefficients):
        y = (y * x + c) % _M
    return y


def _trim(a: list[int]) -> list[int]:
    while a and not a[-1]:
        a.pop()
    return a


def _divide(a: list[int], b: list[int]) -> tuple[list[int], list[int]]:
    """Quotient and remainder by a monic polynomial."""
    a, q = a[:], [0] * max(0, len(a) - len(b) + 1)
    for i in range(len(q) - 1, -1, -1):
        c = q[i] = a[i + len(b) - 1]
        if c:
            for j, y in enumerate(b):
                a[i + j] = (a[i + j] - c * y) % _M
    return q, _trim(a[: len(b) - 1])


def _gcd(a: list[int], b: list[int]) -> list[int]:
    """Monic greatest common divisor."""
    while b:
        k = inverse(b[-1])
        b = [x * k % _M for x in b]
        a, b = b, _divide(a, b)[1]
    k = inverse(a[-1])
    return [x * k % _M for x in a]


def solve(na: int, fa: list[int], nb: int, fb: list[int]) -> tuple[list[int], list[int], int] | None:
    """What two sketches differ in: the polynomials of the elements of a only and of b only, and the bound that sufficed; None if they have too few points."""
    delta, most = na - nb, na + nb
    if delta == 0 and fa == fb:
        return [1], [1], 0
    bound = max(FIRST_BOUND, abs(delta))
    while True:
        bound = min(bound, most)
        bound += (bound - delta) % 2
        if bound + CONFIRM > len(fa):
            return None
        z = [(1 << HASH_BITS) + i for i in range(bound + CONFIRM)]
        n, m = (bound + delta) // 2, (bound - delta) // 2
        # f_b(z) P(z) = f_a(z) Q(z) with P and Q monic of degrees n and m
        system = []
        for w, ga, gb in zip(z[:bound], fa, fb):
            k = [1]
            for _ in range(max(n, m)):
                k.append(k[-1] * w % _M)
            system.append([*(x * gb % _M for x in k[:n]), *(-x * ga % _M for x in k[:m]), (k[m] * ga - k[n] * gb) % _M])
        x = _solve(system) if bound else []
        if x is not None:
            p, q = [*x[:n], 1], [*x[n:], 1]
            if all(_value(p, w) * gb % _M == _value(q, w) * ga % _M for w, ga, gb in zip(z[bound:], fa[bound:], fb[bound:])):
                g = _gcd(p, q)  # a bound above the number of differences leaves a common factor
                return _divide(p, g)[0], _divide(q, g)[0], bound
        if bound >= most:
            raise ArithmeticError("sketches of distinct elements always have a solution under this bound")
        bound *= 2


def sketches(cells: DataFrame, n_points: int, parts: int) -> DataFrame:
    """``bucket, l, n, f``: of each bucket and side the number of its elements and its polynomial at the first n_points points.

    cells: ``bucket, l, h``. A side of a bucket is one run of rows in a partition, multiplied up batch by batch.
    """
    z = points(n_points)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(b: np.ndarray, l: np.ndarray, n: np.ndarray, f: np.ndarray) -> pa.RecordBatch:
            values = pa.ListArray.from_arrays(pa.array(np.arange(len(b) + 1, dtype=np.int32) * n_points), pa.array(f.astype(np.int64).ravel()))
            return pa.record_batch([pa.array(b), pa.array(l), pa.array(n), values], names=["bucket", "l", "n", "f"])

        held: tuple | None = None  # the run that the next batch may go on
        for batch in batches:
            for lo in range(0, batch.num_rows, 16_384):
                part = batch.slice(lo, 16_384)
                b, l, h = (part.column(i).to_numpy(zero_copy_only=False) for i in range(3))
                first = np.flatnonzero(np.append(True, (b[1:] != b[:-1]) | (l[1:] != l[:-1])))
                n = np.diff(np.append(first, len(b)))
                f = _products(sub(z[None, :], h.astype(np.uint64)[:, None]), n)
                b, l = b[first], l[first]
                if held and held[0] == b[0] and held[1] == l[0]:
                    n[0] += held[2]
                    f[0] = mul(f[0], held[3])
                elif held:
                    yield out(*(np.array([x]) for x in held))
                yield out(b[:-1], l[:-1], n[:-1], f[:-1])
                held = (b[-1], l[-1], n[-1], f[-1])
        if held:
            yield out(*(np.array([x]) for x in held))

    rows = cells.select("bucket", "l", "h").repartition(parts, "bucket", "l").sortWithinPartitions("bucket", "l")
    return rows.mapInArrow(run, "bucket bigint, l boolean, n bigint, f array<bigint>")


def roots(f: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Which x are roots of the polynomial in their row of f, lowest coefficient first, filled up with zeros."""
    y = np.zeros(len(x), np.uint64)
    for c in f.T[::-1]:
        y = _reduce(mul(y, x) + c)
    return y == 0


def recover(cells: DataFrame, n_rows: int) -> DataFrame:
    """``l, h``: the elements of ``bucket, l, h`` that one side alone has.

    Sketches that are equal are sorted out before Python sees them. Every round the buckets left send sketches of GROWTH times the bound, until none
    is left; a sketch as long as the bucket always suffices.
    """
    spark = cells.sparkSession
    # by rows, as bytes say little of the work; a partition stays below two million rows
    parts = max(min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_rows // 5_000)), -(-n_rows // 2_000_000), 1)

    def interpolate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                fa, fb = (r[f] or [1] * len(r["fa"] or r["fb"]) for f in ("fa", "fb"))
                got = solve(r["na"] or 0, fa, r["nb"] or 0, fb)
                rows += [(r["bucket"], None, None)] if got is None else [(r["bucket"], side, f) for side, f in ((True, got[0]), (False, got[1])) if len(f) > 1]
            b, l, f = zip(*rows) if rows else ((), (), ())
            yield pa.record_batch([pa.array(b, pa.int64()), pa.array(l, pa.bool_()), pa.array(f, pa.list_(pa.int64()))], names=["bucket", "l", "f"])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            l, h, f = batch.column(0), batch.column(1), batch.column(2)
            n = f.value_lengths().to_numpy()
            wide = np.zeros((len(n), n.max(initial=0)), np.uint64)
            wide[np.repeat(np.arange(len(n)), n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)] = f.flatten().to_numpy().astype(np.uint64)
            hit = pa.array(roots(wide, h.to_numpy().astype(np.uint64)))
            yield pa.record_batch([l.filter(hit), h.filter(hit)], names=["l", "h"])

    polynomials, bound, left = None, SKETCH, cells
    while True:
        pick = lambda c, name: [F.max(F.when(c, F.col("n"))).alias(f"n{name}"), F.max(F.when(c, F.col("f"))).alias(f"f{name}")]
        both = sketches(left, bound + CONFIRM, parts).repartition(parts, "bucket").groupBy("bucket").agg(*pick(F.col("l"), "a"), *pick(~F.col("l"), "b"))
        unequal = both.where(~(F.col("na").eqNullSafe(F.col("nb")) & F.col("fa").eqNullSafe(F.col("fb"))))
        round_ = cut(unequal.mapInArrow(interpolate, "bucket bigint, l boolean, f array<bigint>"))
        got = round_.where("l is not null")
        polynomials = got if polynomials is None else polynomials.unionByName(got)
        open_ = round_.where("l is null").select("bucket")
        if open_.isEmpty():
            break
        left, bound = left.join(open_, "bucket", "left_semi"), bound * GROWTH
    return cells.join(polynomials, ["bucket", "l"]).select("l", "h", "f").mapInArrow(find, "l boolean, h bigint")


def entries(c: Column | str) -> Column:
    """A packed list as a sorted set: entries between semicolons without outer blanks, empty ones and repeats."""
    parts = F.transform(F.split(blank(c), ";"), strip)
    return F.array_join(F.array_sort(F.array_distinct(F.filter(parts, lambda x: x != ""))), ";")


def one_value(c: Column | str) -> Column:
    return strip(blank(c))


def differences(df: DataFrame, key: str = "sync_id", side: str = "compare_side", stamp: str = "scanned_at", left: str = "incremental", right: str = "full", sets: tuple[str, ...] = ("authors", "tags", "identifiers"), values: tuple[str, ...] = ("publisher",), bucket: int = BUCKET) -> DataFrame:
    """What differs between the copies: ``key, difference, left_value, right_value``; difference is ``<side>_missing`` or a field.

    Of each key and side the row with the latest stamp counts (null first; of equal stamps one that its hash decides). Sets are compared without
    regard to outer blanks, empty entries, repeats and order, values without outer blanks; null equals empty. A null key is
    a key like any other. Rows of other sides are ignored. Empty tables give an empty result; other columns are not read.

    Rows are reduced to (key, side, latest stamp, hash) by partial aggregation, so a key may hold any share of the rows. Buckets
    hold about ``bucket`` hashes, of which sketches travel; values travel for differing rows only, found by their keys. The hash has 60 bits: two
    differing rows are taken for equal with a chance of 2^-60 a row.
    """
    fields = [*sets, *values]
    mask = F.lit((1 << HASH_BITS) - 1)

    def hashed(d: DataFrame) -> DataFrame:
        norm = d.select(F.col(key).alias("k"), (F.col(side) == left).alias("l"), F.col(stamp).alias("ts"), *[entries(f).alias(f"v_{f}") for f in sets], *[one_value(f).alias(f"v_{f}") for f in values])
        return norm.withColumn("h", F.xxhash64(F.col("k").isNull(), "k", *[f"v_{f}" for f in fields]).bitwiseAND(mask))

    mine = df.where(F.col(side).isin(left, right))
    latest = cut(hashed(mine).groupBy("k", "l").agg(F.max(F.struct("ts", "h"))["h"].alias("h")))
    n_rows = latest.count()
    n = max(1, -(-n_rows // bucket))
    cells = latest.select(F.pmod(F.xxhash64("k", F.lit(7)), F.lit(n)).alias("bucket"), "l", "h")
    found = cut(recover(cells, n_rows))
    keys = latest.join(found, ["l", "h"], "left_semi").select(F.col("k").alias("_k")).distinct()
    rows = hashed(mine.join(keys, F.col(key).eqNullSafe(F.col("_k")), "left_semi")).join(found, ["l", "h"], "left_semi")
    # of a key and side only the latest row can be among them, with its repeats; an older one that equals a found one is the same row
    sided = rows.groupBy("k").agg(*[F.max(F.when(c, F.struct(*[f"v_{f}" for f in fields]))).alias(s) for s, c in (("a", F.col("l")), ("b", ~F.col("l")))])
    facts = [F.struct(F.lit(f"{s}_missing").alias("difference"), F.lit(None).cast("string").alias("left_value"), F.lit(None).cast("string").alias("right_value"), F.col(c).isNull().alias("yes")) for s, c in ((left, "a"), (right, "b"))]
    facts += [F.struct(F.lit(f).alias("difference"), F.col(f"a.v_{f}").alias("left_value"), F.col(f"b.v_{f}").alias("right_value"), F.coalesce(F.col(f"a.v_{f}") != F.col(f"b.v_{f}"), F.lit(False)).alias("yes")) for f in fields]
    return sided.select(F.col("k").alias(key), F.explode(F.array(*facts)).alias("x")).where("x.yes").select(key, "x.difference", "x.left_value", "x.right_value")
