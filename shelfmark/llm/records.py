"""Records that agree but for the way they are written (problem 2): Merkle-style hashing from the leaves up.

A record is a tree: title (an unordered node), size, and the unordered list of its paths. Leaves are normalised to letters and digits and
hashed, child digests are sorted at unordered nodes and hashed to the node's digest, and records with one root digest are candidates. A title's
leaves are its single letters, as the marks between its parts may be lost; a comparison of the whole normalised structure decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.session import cut
from shelfmark.functions.text import blank, letters
from shelfmark.llm.forms import skeleton

#: What may stand between the parts of a title: brackets, a colon, a bar, a tab, a spaced dash, list marks.
PART_MARKS = r"[()\[\]{}（）［］【】〔〕:：|｜/／;；,，、\t_]+|\s+[-–—~]+\s+|[-–—]+"

#: Titles of up to so many parts are linked by writing out every order of the parts (24 keys at most); longer ones by a search (see reorder).
WRITTEN_OUT = 4


def tidy(c: Column | str) -> Column:
    """Letters and digits of a text in one width, without case; null counts as empty."""
    return letters(skeleton(blank(c), letters=False))


def path_leaves(c: Column | str) -> Column:
    """The listed paths, normalised, empty ones dropped, sorted: equal for every order of the list."""
    return F.array_sort(F.filter(F.transform(F.split(skeleton(blank(c), letters=False), "[;；]"), letters), lambda p: p != ""))


def title_parts(c: Column | str) -> Column:
    """The title's parts as letters and digits, in their order, empty ones dropped."""
    return F.filter(F.transform(F.split(skeleton(blank(c), letters=False), PART_MARKS), letters), lambda p: p != "")


def node(children: Column) -> Column:
    """Digest of an unordered node: a hash of its children's digests, sorted."""
    return F.xxhash64(F.array_sort(children))


def leaves(texts: Column) -> Column:
    """Digests of the leaves of a list."""
    return F.transform(texts, lambda x: F.xxhash64(x))


def _orders(parts: Column) -> Column:
    """Every text that up to WRITTEN_OUT parts give in some order."""

    def drop(a: Column, i: Column) -> Column:
        return F.concat(F.slice(a, F.lit(1), i), F.slice(a, i + 2, F.size(a)))

    # (prefix, rest) pairs grow by one part a round
    state = F.array(F.struct(F.lit("").alias("p"), parts.alias("r")))
    for _ in range(WRITTEN_OUT):
        state = F.flatten(
            F.transform(
                state,
                lambda s: F.when(F.size(s["r"]) == 0, F.array(s)).otherwise(
                    F.transform(
                        F.sequence(F.lit(0), F.greatest(F.size(s["r"]) - 1, F.lit(0))),
                        lambda i: F.struct(F.concat(s["p"], F.get(s["r"], i)).alias("p"), drop(s["r"], i).alias("r")),
                    )
                ),
            )
        )
    return F.array_distinct(F.transform(state, lambda s: s["p"]))


def reorder(a: list[str], b: list[str]) -> bool:
    """Whether the parts of a in some order and the parts of b in some order make the same text.

    A search over prefixes: the text is built from the left, always with a part of the side that is behind, which must go on as the side that
    is ahead does. States met before are not entered again.
    """
    if sorted("".join(a)) != sorted("".join(b)):
        return False
    todo, seen = [(tuple(sorted(a)), tuple(sorted(b)), "")], set()
    while todo:
        state = todo.pop()
        if state in seen:
            continue
        seen.add(state)
        ahead, behind, over = state  # over: what the side ahead has more
        if not behind and not over:
            return not ahead
        for i, p in enumerate(behind):
            if i and behind[i - 1] == p:
                continue
            rest = behind[:i] + behind[i + 1 :]
            if p.startswith(over):
                todo.append((rest, ahead, p[len(over) :]))
            elif over.startswith(p):
                todo.append((ahead, rest, over[len(p) :]))
    return False


def structure(df: DataFrame, title: str, size: str, paths: str) -> DataFrame:
    """Adds the normalised tree: _flat (the title's letters), _parts, _bytes, _paths, and its _root digest."""
    t = df.withColumn("_flat", tidy(title)).withColumn("_parts", title_parts(title)).withColumn("_bytes", F.coalesce(F.col(size).cast("bigint"), F.lit(0).cast("bigint"))).withColumn("_paths", path_leaves(paths))
    return t.withColumn("_root", F.xxhash64(node(leaves(F.split("_flat", ""))), F.col("_bytes"), node(leaves(F.col("_paths"))))).withColumn("_paths", F.array_join("_paths", ";"))


NODE = ["_root", "_bytes", "_paths"]


def _classes(nodes: DataFrame) -> DataFrame:
    """``s, label`` of distinct structures (NODE, s, _flat, _parts): structures that link, over any number of steps, share the least label.

    Keys that two structures share make the links: the title's letters, its parts whatever their order, and every order of few parts written
    out. A structure of many parts is compared with those of its root by a search, and a match is a key of its own.
    """
    few = F.col("_parts")
    bag = F.concat(F.lit("\x1e"), F.array_join(F.array_sort(few), "\x1f"))
    written = F.when(F.size(few).between(2, WRITTEN_OUT), _orders(few)).otherwise(F.array().cast("array<string>"))
    ways = F.array_union(F.array("_flat", bag), written)
    keyed = nodes.select(*NODE, "s", F.explode(ways).alias("way"))
    long = nodes.where(F.size(few) > WRITTEN_OUT)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hit = [i for i, (x, y) in enumerate(zip(b.column(5).to_pylist(), b.column(6).to_pylist())) if reorder(x, y)]
            yield b.take(pa.array(hit, pa.int64())).select(range(5))

    other = nodes.select(*NODE, F.col("s").alias("o"), F.when(F.size(few) > 0, few).otherwise(F.array("_flat")).alias("_other"), bag.alias("_bag"))
    pairs = long.withColumn("_own", bag).join(other, NODE).where((F.col("s") != F.col("o")) & (F.col("_own") != F.col("_bag"))).select(*NODE, "s", "o", "_parts", "_other")
    matched = pairs.mapInArrow(search, "_root bigint, _bytes bigint, _paths string, s bigint, o bigint")
    link = matched.select(*NODE, F.concat_ws("\x1d", F.lit(""), F.col("s").cast("string"), F.col("o").cast("string")).alias("way"), F.explode(F.array("s", "o")).alias("s"))
    keyed = cut(keyed.unionByName(link.select(*NODE, "s", "way")).withColumn("label", F.col("s")))
    while True:
        best = keyed.groupBy(*NODE, "way").agg(F.min("label").alias("label"))
        least = keyed.drop("label").join(best, [*NODE, "way"]).groupBy("s").agg(F.min("label").alias("label"))
        new = cut(keyed.withColumnRenamed("label", "_old").join(least, "s"))
        if new.where("label <> _old").isEmpty():
            return new.select("s", "label").distinct()
        keyed = new.drop("_old")


def copies(df: DataFrame, key: str = "data_id", title: str = "title", size: str = "bytes", paths: str = "init_path") -> DataFrame:
    """One row per record key that has a copy: ``first_<key>``, ``<key>``; the first is the smallest key of its class.

    Two records are copies if size (null as 0), title letters (in some order of the title's parts) and the
    listed paths' letters (in any order) agree. Records written alike in full are copies. Rows of one key that agree count once.

    The tree is derived once and kept in the checkpoint folder. Root digests are aggregated to the least and greatest key with partial sums, so
    a class of any size is two numbers per task; rows whose digest another key shares are reduced to distinct structures, and where a root
    has several of them these are compared in full: two link if they share the title's letters under some order of the parts that either of
    them marks, whatever their number. A title without any mark left is so linked by one that has it. Links are followed until no label
    changes. Null and empty title or paths are equal to each other. Rows with a null key are left out; an empty table gives an empty
    result; other columns are not read.
    """
    base = df.where(F.col(key).isNotNull()).select(F.col(key).cast("bigint").alias("k"), F.col(title).alias("t"), F.col(size).alias("b"), F.col(paths).alias("p"))
    rows = cut(structure(base, "t", "b", "p").select("k", "_root", "_bytes", "_paths", "_flat", "_parts", F.xxhash64("_root", "_bytes", "_paths", "_flat", "_parts").alias("s")))
    shared = rows.groupBy("_root").agg(F.min("k").alias("lo"), F.max("k").alias("hi")).where("lo < hi").select("_root")
    suspects = rows.join(shared, "_root", "left_semi")
    # most roots have one structure; the rest is small
    structures = suspects.groupBy(*NODE, "s", "_flat", "_parts").agg(F.min("k").alias("least"))
    several = structures.groupBy(*NODE).agg(F.count("*").alias("n")).where("n > 1").drop("n")
    labels = _classes(cut(structures.join(several, NODE, "left_semi").drop("least")))
    member = rows.select("k", "_root", "s").join(shared, "_root", "left_semi").select("k", "s").distinct().join(labels, "s", "left").select("k", F.coalesce("label", "s").alias("label")).distinct()
    firsts = member.groupBy("label").agg(F.min("k").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    found = member.join(firsts, "label").where("k > first")
    return found.select(F.col("first").alias(f"first_{key}"), F.col("k").alias(key)).distinct()


def collapse(df: DataFrame, key: str = "data_id", title: str = "title", size: str = "bytes", paths: str = "init_path") -> DataFrame:
    """The table without further copies: the first record of each class with ``n_copies``, the number of its keys; 1 where it has none.

    All columns of the input are kept; of several rows of a surviving key all stay.
    """
    c = copies(df, key, title, size, paths)
    n = c.groupBy(F.col(f"first_{key}").alias("_first")).agg((F.count("*") + 1).alias("_n"))
    rest = df.join(c.select(F.col(key).alias("_gone")), df[key] == F.col("_gone"), "left_anti")
    return rest.join(n, rest[key] == n["_first"], "left").withColumn("n_copies", F.coalesce("_n", F.lit(1).cast("bigint"))).drop("_first", "_n")
