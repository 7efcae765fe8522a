"""Filling containers of fixed capacity (problem 8): sum-of-squares online packing.

Each item goes to the fill level that leaves the sum of squared counts of partly filled containers least. The state is an array
of counts by level, so an item costs one look at the occupied levels, however many containers are open.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.session import cut
from shelfmark.llm.tokens import VOCABULARY, sized

#: Items one packer sees; more items, more packers. The open containers at its end are the only room lost to it.
SHARD = 50_000


def pack_sizes(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Container and place in it of each item, in the order of arrival, and the number of containers. Sizes are 1..capacity."""
    count = np.zeros(capacity + 1, np.int64)
    open_at: dict[int, list[int]] = {}
    held: list[int] = []
    box, place = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    for i, w in enumerate(sizes.tolist()):
        best = 0
        if w < capacity:
            at = np.flatnonzero(count[1 : capacity - w + 1]) + 1
            # change of the sum: one less at the level, one more at the new one unless the container is full
            cost_new = 2 * int(count[w]) + 1
            if len(at):
                change = 1 - 2 * count[at] + np.where(at + w < capacity, 2 * count[at + w] + 1, 0)
                k = len(at) - 1 - int(np.argmin(change[::-1]))  # of equal ones the fullest
                if change[k] <= cost_new:
                    best = int(at[k])
        if best:
            b = open_at[best].pop()
            count[best] -= 1
        else:
            b = len(held)
            held.append(0)
        box[i], place[i] = b, held[b]
        held[b] += 1
        if best + w < capacity:
            open_at.setdefault(best + w, []).append(b)
            count[best + w] += 1
    return box, place, len(held)


def pack_sized(items: DataFrame, limits: DataFrame, key: str = "doc_id", size: str = "n_tokens", limit: str = "limit_id", capacity: str = "capacity_tokens", shard: int = SHARD) -> DataFrame:
    """The contents of each container: ``limit, container_id, place, key, start_token, n_tokens``.

    Every item is in exactly one container per limit, whole, unless it exceeds the capacity: then it is cut into full containers
    and a remainder that is packed like an item; start_token tells the parts apart. An item without size takes no room
    and has a null container. container_id is unique within a limit. Items are dealt to packers by a hash of the key, about
    ``shard`` each, and arrive in the order of the key, so the result does not depend on partitioning. Rows
    with a null key are packed too; repeated rows are items of their own; an empty table gives an empty result. Limits without a
    capacity above zero are left out.
    """
    n = items.count()
    shards = max(1, -(-n // shard))
    lim = limits.where(F.col(capacity) > 0).select(F.col(limit).cast("bigint").alias("l"), F.col(capacity).cast("bigint").alias("c")).distinct()
    # the limits are a stated set; each item meets each of them
    caps = F.array(*[F.struct(F.lit(r.l).cast("bigint").alias("l"), F.lit(r.c).cast("bigint").alias("c")) for r in lim.collect()] or [F.struct(F.lit(0).cast("bigint").alias("l"), F.lit(0).cast("bigint").alias("c"))])
    rows = items.select(F.col(key).cast("bigint").alias("k"), F.coalesce(F.col(size), F.lit(0)).cast("bigint").alias("n"), F.pmod(F.xxhash64(F.col(key)), F.lit(shards)).alias("shard"), F.explode(caps).alias("x")).select("k", "n", "shard", "x.l", "x.c").where("c > 0")

    def run(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(["k", "n"], kind="stable")
        c, first = int(g["c"].iloc[0]), int(g["shard"].iloc[0]) << 36
        n, k = g["n"].to_numpy(), g["k"].to_numpy()
        whole, rest = n // c, n % c
        box, place, used = pack_sizes(rest[rest > 0], c)
        own = np.flatnonzero(rest > 0)
        cut = np.repeat(np.arange(len(n)), whole)
        part = np.arange(len(cut)) - np.repeat(np.append(0, np.cumsum(whole)[:-1]), whole)
        none = np.flatnonzero(n == 0)
        at = np.concatenate([own, cut, none])
        return pd.DataFrame(
            {
                "l": g["l"].iloc[0],
                "container": pd.array(np.concatenate([box + first, used + first + np.arange(len(cut)), np.zeros(len(none), np.int64)]), "Int64"),
                "place": np.concatenate([place, np.zeros(len(cut) + len(none), np.int64)]),
                "k": g["k"].iloc[at].to_numpy() if g["k"].hasnans else k[at],
                "start": np.concatenate([(whole * c)[own], part * c, np.zeros(len(none), np.int64)]),
                "n": np.concatenate([rest[own], np.full(len(cut), c), np.zeros(len(none), np.int64)]),
            }
        ).assign(container=lambda d: d["container"].mask(d["n"] == 0))

    out = rows.groupBy("shard", "l").applyInPandas(run, "l bigint, container bigint, place bigint, k bigint, start bigint, n bigint")
    return out.select(F.col("l").alias(limit), F.col("container").alias("container_id"), F.col("place").cast("int").alias("place"), F.col("k").alias(key), F.col("start").alias("start_token"), F.col("n").alias("n_tokens"))


def pack_documents(docs: DataFrame, limits: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY, shard: int = SHARD) -> DataFrame:
    """pack_sized() of texts measured in tokens. Texts are tokenised once; their sizes are kept in the checkpoint folder."""
    return pack_sized(cut(sized(docs, key, text, vocabulary)), limits, key, shard=shard)
