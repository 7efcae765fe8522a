"""New batches against all history (problem 5): a table of distances to fixed pivots, laid out by ranges.

The metric is the edit distance of normalised texts. Each text's distances to a few fixed pivots are computed once, when
its batch arrives, and stored. By the triangle inequality two texts within distance d differ by at most d in each pivot distance,
so a new batch meets only the ranges of the table that its own sizes and distances allow; the true distance then decides.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions.session import new_folder
from shelfmark.functions.text import blank, file_name, letters
from shelfmark.llm.forms import skeleton

#: Fixed texts far from each other and from most titles; any texts are right, these only decide how much is pruned.
PIVOTS = ("", "abcdefghijklmnopqrst", "的之与和一册卷二三山", "the of a in and vol part book")
#: Most edits between texts that agree, and the most that sizes differ as a share of the larger.
EDITS, SIZE_SHARE = 2, 0.005
#: Width of a range of sizes as a share, of a range of the first pivot distance, and size ranges per zone (a folder of the table).
SIZE_WIDTH, PIVOT_WIDTH, ZONE = 0.02, 8, 64
#: The numerals of Chinese numbers.
NUMERALS = "〇零一二三四五六七八九十百千万亿两"


def comparable(c: Column | str) -> Column:
    """The text without case, width, blanks and punctuation."""
    return letters(skeleton(c, letters=False))


def number_key(text: Column) -> Column:
    """The digits and Chinese numerals in their order."""
    return F.regexp_replace(text, rf"[^\p{{Nd}}{NUMERALS}]", "")


def stem(path: Column | str) -> Column:
    """File name without directories and without the extension."""
    return F.regexp_replace(file_name(path), r"\.[^.]*$", "")


def signatures(df: DataFrame, key: str = "data_id", batch: str = "batch", ext: str = "ext", size: str = "bytes", texts: dict[str, Column] | None = None) -> DataFrame:
    """One row per record and kind of text: ``k, batch, sig, zone, same, bytes, text``.

    ``same`` is a hash of what must be equal (kind, ext, digits and numerals), ``sig`` names the (same, bytes, text) that equal rows share,
    ``zone`` is a coarse range of sizes. A row without key or size, and a text that is null or has no letter or digit, agree with nothing
    and get no row.
    """
    texts = texts or {"title": F.col("title"), "file": stem("relative_path")}
    base = df.where(F.col(key).isNotNull() & F.col(size).isNotNull())
    kinds = F.explode(F.array(*[F.struct(F.lit(n).alias("kind"), comparable(c).alias("text")) for n, c in texts.items()])).alias("x")
    rows = base.select(F.col(key).cast("bigint").alias("k"), F.col(batch).alias("batch"), F.lower(blank(ext)).alias("ext"), F.col(size).cast("bigint").alias("bytes"), kinds).where("x.text <> ''")
    must = F.md5(F.concat_ws("\x1f", "x.kind", "ext", number_key(F.col("x.text"))))
    sig = F.unhex(F.md5(F.concat_ws("\x1f", "x.kind", "ext", F.col("bytes").cast("string"), "x.text")))
    return rows.select("k", "batch", sig.alias("sig"), zone(_size_range(F.col("bytes"))).alias("zone"), F.xxhash64(must).alias("same"), "bytes", F.col("x.text").alias("text"))


def _log(b: Column) -> Column:
    return F.log(b.cast("double")) / math.log1p(SIZE_WIDTH)


def _size_range(b: Column) -> Column:
    """Ranges of sizes; sizes of zero or less have their own each, as only equal ones agree."""
    return F.when(b > 0, F.floor(_log(b))).otherwise(b - 1).cast("bigint")


def _near_sizes(b: Column) -> Column:
    """The size ranges in which sizes within SIZE_SHARE lie."""
    d = -math.log1p(-SIZE_SHARE) / math.log1p(SIZE_WIDTH) + 1e-9
    return F.when(b > 0, F.sequence(F.greatest(F.floor(_log(b) - d), F.lit(0)), F.floor(_log(b) + d))).otherwise(F.array(_size_range(b)))


def zone(size_range: Column) -> Column:
    """At most a few dozen zones cover all sizes."""
    return F.when(size_range < 0, F.lit(-1)).otherwise(F.floor(size_range / ZONE)).cast("int")


def pivots(text: Column) -> Column:
    """The distances to PIVOTS in one number, 15 bits each; beyond that they count as 32767, which keeps the triangle inequality."""
    out = F.lit(0).cast("bigint")
    for i, p in enumerate(PIVOTS):
        out = out + F.shiftleft(F.least(F.levenshtein(text, F.lit(p)), F.lit(32767)).cast("bigint"), 15 * i)
    return out


def _distance(p: Column, i: int) -> Column:
    return F.shiftright(p, 15 * i).bitwiseAND(32767)


def distinct_signatures(rows: DataFrame) -> DataFrame:
    """The rows of the pivot table: one per signature, ``sig, zone, same, bytes, text, p``; many: more than one record has it."""
    one = rows.groupBy("sig", "zone", "same", "bytes", "text").agg((F.min("k") < F.max("k")).alias("many"))
    return one.withColumn("p", pivots(F.col("text")))


def agreeing(new: DataFrame, history: DataFrame | None = None, edits: int = EDITS, within: bool = True) -> DataFrame:
    """Pairs of signatures that agree, of new with history and, unless within is false, with new (own): ``sig_n, sig_h, own``.

    The join key is (same, size range, range of the first pivot distance): each signature of history lies in one range, and those of the new
    side are laid out over the two or three that theirs reach, so a pair meets once. The other pivots and the size prune before the true
    distance is computed. A signature of new agrees with itself only where several records have it.
    """
    cols = ["sig", "same", "bytes", "text", "p", "many"]
    range_of = lambda d: F.floor(d / PIVOT_WIDTH).cast("int")
    own = new.where(F.lit(within)).withColumn("own", F.lit(True))
    known = own if history is None else history.withColumn("own", F.lit(False))
    if within and history is not None:
        known = own.unionByName(known)
    h = known.select("own", *[F.col(c).alias(f"{c}_h") for c in cols], _size_range(F.col("bytes")).alias("sr"), range_of(_distance(F.col("p"), 1)).alias("pr"))
    at = _distance(F.col("p"), 1)
    n = new.withColumn("sr", F.explode(_near_sizes(F.col("bytes")))).withColumn("pr", F.explode(F.sequence(range_of(F.greatest(at - edits, F.lit(0))), range_of(at + edits))))
    n = n.select(*[F.col(c).alias(f"{c}_n") for c in cols], "sr", "pr")
    cond = (F.col("same_n") == F.col("same_h")) & (n["sr"] == h["sr"]) & (n["pr"] == h["pr"])
    for i in range(len(PIVOTS)):
        cond &= F.abs(_distance(F.col("p_n"), i) - _distance(F.col("p_h"), i)) <= edits
    cond &= F.abs(F.col("bytes_n") - F.col("bytes_h")) <= SIZE_SHARE * F.greatest(F.abs("bytes_n"), F.abs("bytes_h"))
    cond &= ~F.col("own") | (F.col("sig_n") != F.col("sig_h")) | F.col("many_n")
    return n.join(h, cond).where(F.levenshtein("text_n", "text_h", edits).between(0, edits)).select("sig_n", "sig_h", "own")


def _pairs(p: DataFrame, new: DataFrame, history: DataFrame, key: str) -> DataFrame:
    """Pairs of records from pairs of signatures."""
    a = new.select(F.col("sig").alias("sig_n"), F.col("k").alias("a"), F.col("batch").alias("ba"))
    b = history.select(F.col("sig").alias("sig_h"), F.col("k").alias("b"), F.col("batch").alias("bb"))
    both = p.join(a, "sig_n").join(b, "sig_h").where(~F.col("ba").eqNullSafe(F.col("bb")) & (F.col("a") != F.col("b")))
    return both.select(F.least("a", "b").alias(f"{key}_a"), F.greatest("a", "b").alias(f"{key}_b")).distinct()


class PivotTable:
    """History on disk. ``add`` stores what arrives and checks it against all that was stored before and against itself.

    Below the path, ``keys/add=N`` has a row per record and kind of text (k, batch, sig), ``sigs/add=N/zone=Z`` one per signature with text and pivot
    distances, sorted by size within a file, and ``found/add=N`` the pairs of signatures that agree. An add reads of history only the
    zones its own sizes reach. Adds are numbered; one that was cut off before its marker ``done/add=N`` is written does not count and is
    written anew, so a re-run stores nothing twice.
    """

    def __init__(self, spark: SparkSession, path: str | None = None) -> None:
        self.spark, self.path = spark, path or new_folder(spark, "pivots")

    def adds(self) -> list[int]:
        """Numbers of the finished adds."""
        jvm = self.spark._jvm
        at = jvm.org.apache.hadoop.fs.Path(f"{self.path}/done")
        fs = at.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return sorted(int(s.getPath().getName().split("=")[1]) for s in fs.listStatus(at)) if fs.exists(at) else []

    def _read(self, what: str, adds: list[int]) -> DataFrame:
        schema = {"keys": "k long, batch string, sig binary", "sigs": "sig binary, same long, bytes long, text string, many boolean, p long, zone int", "found": "sig_n binary, sig_h binary, own boolean"}[what]
        rows = self.spark.read.schema(schema).option("basePath", f"{self.path}/{what}").parquet(*[f"{self.path}/{what}/add={i}" for i in adds])
        return rows.select(*[c.split()[0] for c in schema.split(", ")])

    def add(self, batches: DataFrame, key: str = "data_id", **columns: str) -> DataFrame:
        """Pairs ``<key>_a, <key>_b`` of records from different batches that agree, one side new, the other new or in history.

        batches: the rows of one batch or of several. Every pair of a file is returned, not only neighbours; a pair within one batch, and a key
        with itself, are none. A null batch equals only another null. Rows that repeat another in full count once. Empty tables give an empty
        result. The result is read from the table, so it stays the same whatever is added later.
        """
        old = self.adds()
        no = max(old, default=0) + 1
        at = lambda what: f"{self.path}/{what}/add={no}"
        signatures(batches, key, **columns).write.mode("overwrite").parquet(at("keys"))
        full = self.spark.read.schema("k long, batch string, sig binary, zone int, same long, bytes long, text string").parquet(at("keys"))
        distinct_signatures(full).sortWithinPartitions("zone", "bytes").write.mode("overwrite").partitionBy("zone").parquet(at("sigs"))
        new = self._read("sigs", [no])
        # rows of one batch make no pair with each other
        n, named, least, last = full.agg(F.count("*"), F.count("batch"), F.min("batch"), F.max("batch")).first()
        within = 0 < named < n or least != last
        history = None
        if old:
            # a size near the edge of its zone reaches the next one; a few dozen zones at most
            reach = new.select(F.explode(_near_sizes(F.col("bytes"))).alias("r")).select(zone(F.col("r")).alias("z")).distinct()
            history = self._read("sigs", old).where(F.col("zone").isin([r.z for r in reach.collect()]))
        agreeing(new, history, within=within).write.mode("overwrite").parquet(at("found"))
        done = self.spark._jvm.org.apache.hadoop.fs.Path(at("done"))
        done.getFileSystem(self.spark._jsc.hadoopConfiguration()).mkdirs(done)
        return self.check(no, key)

    def check(self, no: int, key: str = "data_id") -> DataFrame:
        """The result of an add."""
        found, mine = self._read("found", [no]), self._read("keys", [no])
        pairs = _pairs(found.where("own"), mine, mine, key)
        old = [i for i in self.adds() if i < no]
        return pairs.unionByName(_pairs(found.where("not own"), mine, self._read("keys", old), key)).distinct() if old else pairs


def check_batch(new: DataFrame, history: DataFrame | None = None, key: str = "data_id") -> DataFrame:
    """One check without keeping the table: pairs of new with history, and within new."""
    t = PivotTable(new.sparkSession)
    if history is not None:
        t.add(history, key)
    return t.add(new, key)
