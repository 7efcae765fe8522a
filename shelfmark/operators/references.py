"""References to records that do not exist (problem 7): sorted parent arrays by key range, probed by binary search.

Keys are cut into ranges, as wide as it takes to hold about RANGE parents at the parents' mean density. Of each range the parents are one sorted
array of validity spans, and the references come in batches; a batch is answered by a vectorised binary search. A range where parents
or references crowd is cut finer, and references that even one key has too many of are dealt to several batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys per range, and distinct references per batch, aimed at.
RANGE, BATCH = 16_384, 65_536
FOREVER = 2**63 - 1


def spans(parents: DataFrame, key: str, start: str, end: str | None) -> DataFrame:
    """The times at which each key exists: ``k, s, e`` in microseconds, e excluded, without repeats. A null start is always."""
    e = F.coalesce(F.unix_micros(F.col(end).cast("timestamp")), F.lit(FOREVER)) if end else F.lit(FOREVER)
    s = F.coalesce(F.unix_micros(F.col(start).cast("timestamp")), F.lit(-FOREVER))
    return parents.where(F.col(key).isNotNull()).select(F.col(key).cast("bigint").alias("k"), s.alias("s"), e.alias("e")).where("s < e").distinct()


def _probe(k: np.ndarray, s: np.ndarray, e: np.ndarray, ref: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Which references find a span of their key that holds their time. Spans are sorted by (k, s), e running maxima per key."""
    if not len(k):
        return np.zeros(len(ref), bool)
    order = np.lexsort((s, k))
    k, s, e = k[order], s[order], e[order]
    new = np.append(True, k[1:] != k[:-1])
    if not new.all():
        # the latest end so far among the spans of a key that have begun: running maxima of ranks, restarted at each key
        seg, by = np.cumsum(new) - 1, np.argsort(e, kind="stable")
        rank = np.empty(len(e), np.int64)
        rank[by] = np.arange(len(e))
        e = e[by][np.maximum.accumulate(seg * len(e) + rank) - seg * len(e)]
    # last span of the key that has begun at the time: a search over the pairs, by rank of time within the sorted keys
    lo, hi = np.searchsorted(k, ref, "left"), np.searchsorted(k, ref, "right")
    live = lo < hi
    a, b = lo.copy(), hi.copy()
    while True:
        open_ = a < b
        if not open_.any():
            break
        mid = (a + b) // 2
        m = np.minimum(mid, len(k) - 1)
        right = open_ & (s[m] <= at)
        a = np.where(right, mid + 1, a)
        b = np.where(open_ & ~right, mid, b)
    last = a - 1
    ok = live & (last >= lo)
    ok[ok] = e[last[ok]] > at[ok]
    return ok


def orphans(refs: DataFrame, parents: dict[str, tuple[DataFrame, str, str, str | None]], period: str, at: str, range_size: int = RANGE, batch: int = BATCH) -> DataFrame:
    """Orphan references per field and period: ``ref_field, ref_id, period, n_times``, n_times counting distinct times seen.

    ``parents`` names, for each reference column, the table, its key, and the columns from which and until before which a row counts.
    A reference is an orphan if at its time no row of its key counts: none at all, later ones, or deleted ones. Null references and
    such without a time are none. Repeated rows count once. An empty table of references gives an empty result, an empty table
    of parents makes every reference an orphan.

    References are reduced to distinct (field, id, period, time) by partial aggregation first, so a key named by any share of the rows costs
    as many probes as it has distinct times. Ranges that hold more than ``batch`` references or parents are cut to ``range_size`` key values, and
    their references dealt to batches, with the parents laid out once per batch. Such ranges are few, but their list is joined like any
    table; nothing is broadcast or collected but the count, least and greatest key of each parent table. The spans of one key stay in one array.
    """
    stack = [F.struct(F.lit(f).alias("f"), F.col(f).cast("bigint").alias("k")) for f in parents]
    t = F.unix_micros(F.col(at).cast("timestamp")).alias("t")
    long = refs.select(F.col(period).alias("p"), t, F.explode(F.array(*stack)).alias("x")).select("x.f", "x.k", "p", "t").where("k is not null and t is not null").distinct()
    held, width = None, F.lit(range_size)
    for f, (table, key, start, end) in parents.items():
        d = spans(table, key, start, end)
        n, lo, hi = table.agg(F.count(key), F.min(key), F.max(key)).first()
        width = F.when(F.col("f") == f, F.lit(max(range_size, range_size * ((hi - lo) // n)) if n else range_size)).otherwise(width)
        d = d.withColumn("f", F.lit(f))
        held = d if held is None else held.unionByName(d)
    ranged = lambda d: d.withColumn("r", F.floor(F.col("k") / width))
    load = lambda d, n: ranged(d).groupBy("f", "r").agg(F.count("*").alias(n))
    crowded = load(long, "n").join(load(held, "m"), ["f", "r"], "left").where((F.col("n") > batch) | (F.col("m") > batch)).select("f", "r", F.ceil(F.col("n") / batch).cast("int").alias("salts"))
    # a crowded range's second number is the finer range, any other's is 0
    fine = lambda d: ranged(d).join(crowded, ["f", "r"], "left").withColumn("i", F.when(F.col("salts").isNull(), 0).otherwise(F.floor(F.col("k") / range_size)))
    keys = fine(long).withColumn("salt", F.pmod(F.xxhash64("k", "t", "p"), F.coalesce("salts", F.lit(1)))).select("f", "r", "i", "salt", "k", "p", "t")
    held = fine(held).withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("salts", F.lit(1)).cast("bigint") - 1))).select("f", "r", "i", "salt", "k", "s", "e")
    cell = ["f", "r", "i", "salt"]
    arrays = held.groupBy(*cell).agg(F.collect_list("k").alias("pk"), F.collect_list("s").alias("ps"), F.collect_list("e").alias("pe"))
    probes = keys.groupBy(*cell).agg(F.collect_list(F.struct("k", "p", "t")).alias("q"))
    both = probes.join(arrays, cell, "left").select("f", "q", "pk", "ps", "pe")
    p_type = refs.schema[period].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts(col: pa.ListArray, i: int) -> np.ndarray:
            return col[i].values.to_numpy(zero_copy_only=False).copy() if col[i].is_valid else np.zeros(0, np.int64)

        for b in batches:
            f, q, pk, ps, pe = (b.column(i) for i in range(5))
            for i in range(b.num_rows):
                x = q[i].values
                k, t = x.field("k").to_numpy(zero_copy_only=False), x.field("t").to_numpy(zero_copy_only=False)
                miss = np.flatnonzero(~_probe(parts(pk, i), parts(ps, i), parts(pe, i), k, t))
                yield pa.record_batch([pa.array([f[i].as_py()] * len(miss), pa.string()), pa.array(k[miss]), x.field("p").take(pa.array(miss))], names=["ref_field", "ref_id", "period"])

    missed = both.mapInArrow(run, f"ref_field string, ref_id bigint, period {p_type}")
    return missed.groupBy("ref_field", "ref_id", "period").agg(F.count("*").alias("n_times"))
