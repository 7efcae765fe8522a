"""The best representative of each duplicate group (problem 1), field by field, with currency reasoning.

Where rows carry time stamps, the later value of a field is the more current one. From all such successions the operator learns which traits
values gain and which they lose as they grow current; this orders any two values in part: one is later if it has every gained trait of the other
and lacks every lost one. Where stamps are missing, the values of a group that no other is later than stand for the current one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.text import blank, letters, strip

#: Words that stand for no value, as letters and digits only.
NO_VALUE = (
    "unknown untitled none null na nil nan notapplicable notavailable undefined notitle missing empty tbd "
    "unbekannt ohnetitel keine keiner inconnu sanstitre aucun nonapplicable desconocido sintitulo ninguno "
    "неизвестно неизвестный безназвания нет "
    "未知 未知书名 不详 不明 无题 無題 无 無 无标题 無標題 未命名 空 暂无 佚名 不适用 不適用 なし 不明 無し タイトルなし"
).split()

def text_value(c: Column | str) -> Column:
    """Holds a value: not null, blank, mere marks or a word for its lack."""
    return ~letters(blank(c)).isin("", *NO_VALUE)


def size_value(c: Column | str) -> Column:
    """A size above zero."""
    return F.coalesce((F.col(c) if isinstance(c, str) else c) > 0, F.lit(False))


#: Traits of a text that an edit changes: a bracket, a blank, a list, other than ASCII, length, a capital, a digit, a folder.
TRAITS = (r"[(\[（【]", r"\s", ";", r"[^\x00-\x7f]", r"(?s)^.{61,}", r"\p{Lu}", r"\p{Nd}", r"[/\\]")


def text_traits(c: Column | str) -> Column:
    """A bit per trait."""
    x = strip(blank(c))
    out = F.lit(0).cast("bigint")
    for i, rx in enumerate(TRAITS):
        out = out + F.when(x.rlike(rx), F.lit(1 << i)).otherwise(0)
    return out


def size_traits(c: Column | str) -> Column:
    """Bit i: the size is at least 2 to the power of i + 1; 62 bits."""
    x = F.col(c) if isinstance(c, str) else c
    level = F.when(x > 0, F.floor(F.log2(x.cast("double")))).otherwise(0).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), F.least(level, F.lit(62))) - 1


def precedence(versions: DataFrame, fields: dict[str, Column], margin: float = 2.0) -> dict[str, tuple[int, int]]:
    """Field -> bits that values gain over time and bits that they lose.

    versions: ``g, k, ts`` and what fields (masks, null where there is no value) need. Learned from the first and last stamped value of each record, by
    aggregation with partial results, however many rows a record has. A bit counts if one direction outweighs the other by the margin in standard
    deviations. At most 126 rows a field reach the driver.
    """
    rows = versions.where(F.col("ts").isNotNull()).select("g", "k", "ts", *[m.alias(f"m_{f}") for f, m in fields.items()])
    ends = lambda pick, f: pick(f"m_{f}", F.when(F.col(f"m_{f}").isNotNull(), F.struct("ts", f"m_{f}")))
    two = rows.groupBy("g", "k").agg(*[x for f in fields for x in (ends(F.min_by, f).alias(f"a_{f}"), ends(F.max_by, f).alias(f"b_{f}"))])
    each = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"a_{f}").alias("a"), F.col(f"b_{f}").alias("b")) for f in fields])
    moved = two.select(F.explode(each).alias("x")).select("x.*").where("a <> b").select("field", "a", F.col("a").bitwiseXOR(F.col("b")).alias("d"))
    bit = F.explode(F.filter(F.sequence(F.lit(0), F.lit(62)), lambda i: F.call_function("getbit", F.col("d"), i) == 1))
    n = moved.select("field", "a", bit.alias("i")).groupBy("field", "i").agg(F.count_if(F.expr("getbit(a, i) = 0")).alias("won"), F.count_if(F.expr("getbit(a, i) = 1")).alias("lost")).collect()
    out = {f: (0, 0) for f in fields}
    for r in n:
        gain, loss = out[r.field]
        sure = abs(r.won - r.lost) > margin * (r.won + r.lost) ** 0.5
        out[r.field] = (gain | (sure and r.won > r.lost) << r.i, loss | (sure and r.won < r.lost) << r.i)
    return out


def later(a: Column, b: Column) -> Column:
    """Whether b is later than a, of two values' places in the order (see survivors)."""
    return (a.bitwiseAND(b) == a) & (a != b)


def survivors(df: DataFrame, group: str = "group_key", key: str = "data_id", rank: str = "sort_key", stamp: str = "updated_at", texts: tuple[str, ...] = ("title", "init_path"), sizes: tuple[str, ...] = ("bytes",)) -> DataFrame:
    """The surviving value of each field of each group: ``group, field, key, value``, the key being the record it comes from.

    Of several rows of a record the latest counts, a stamped one before others. A field's value comes from the record of least rank (null last) among
    those that have one; of several such from the most current; of equally current ones from the least key. Currency is the stamp. Where stamps
    are missing, it is the group's partial order: of stamped values the latest, a value without stamp counts as stamped where the group has
    the same one stamped, and otherwise lies where the learned traits put it, which may be nowhere: of values that none is later than the stamped
    one is taken, then that of the least key. No record with a value: no row. Rows with a null group or key are left out.
    Groups of one record are resolved too; ``n_records`` tells them apart. Precedence is learned only if some stamp is missing.

    Groups are aggregated, never collected, so a group may hold any share of the rows; what is gathered of one is the set of its places in the
    order, at most 256 for a text and 63 for a size. An empty table gives an empty result.
    """
    fields = [*texts, *sizes]
    base = df.where(F.col(group).isNotNull() & F.col(key).isNotNull()).select(F.col(group).alias("g"), F.col(key).alias("k"), F.col(rank).cast("int").alias("r"), F.col(stamp).cast("timestamp").alias("ts"), *[F.col(f).alias(f"f_{f}") for f in fields])
    ok = {f: text_value(f"f_{f}") for f in texts} | {f: size_value(f"f_{f}") for f in sizes}
    unstamped = not base.where("ts is null").isEmpty()
    traits = {f: F.when(ok[f], text_traits(f"f_{f}")) for f in texts} | {f: F.when(ok[f], size_traits(f"f_{f}")) for f in sizes}
    learned = precedence(base, traits) if unstamped else {f: (0, 0) for f in fields}

    def place(f: str) -> Column:
        """More bits, more current: gained traits there and lost ones gone."""
        gain, loss = learned[f]
        none = F.lit(0).cast("bigint")
        return F.coalesce(traits[f].bitwiseAND(gain).bitwiseOR(F.bitwise_not(traits[f]).bitwiseAND(loss)), none) if gain or loss else none

    # each value judged once: null where it is none, with its place
    judged = base.select("g", "k", "r", "ts", *[F.when(ok[f], F.col(f"f_{f}").cast("string")).alias(f"v_{f}") for f in fields], *[place(f).alias(f"o_{f}") for f in fields])
    total = sum((F.bit_count(f"o_{f}") for f in fields[1:]), F.bit_count(f"o_{fields[0]}"))
    kept = [c for f in fields for c in (f"v_{f}", f"o_{f}")]
    # one row per record: stamped before unstamped, then the latest, then the furthest in the order, then by content so that ties are settled
    row = F.struct(F.col("ts").isNotNull().alias("a"), F.coalesce(F.unix_micros("ts"), F.lit(0)).alias("b"), total.alias("c"), *kept, "r", "ts")
    recs = judged.groupBy("g", "k").agg(F.max(row).alias("m")).select("g", "k", "m.r", "m.ts", *[f"m.{c}" for c in kept])
    each = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"v_{f}").alias("value"), F.col(f"o_{f}").alias("o")) for f in fields])
    long = recs.select("g", "k", F.struct(F.col("r").isNull().alias("none"), F.coalesce("r", F.lit(0)).alias("r")).alias("r"), F.unix_micros("ts").alias("cur"), F.explode(each).alias("x")).select("g", "k", "r", "cur", "x.*").where("value is not null")
    n = recs.groupBy("g").agg(F.count("*").alias("n_records"))
    current = long
    if unstamped:
        lead = long.groupBy("g", "field").agg(F.min("r").alias("lead"), F.bool_or(F.col("cur").isNull()).alias("open"))
        tied = long.join(lead, ["g", "field"]).where("r = lead")
        same = tied.where("open and cur is not null").groupBy("g", "field", "value").agg(F.max("cur").alias("same"))
        placed = tied.where("open").join(same, ["g", "field", "value"], "left").withColumn("cur", F.coalesce("cur", "same"))
        top = placed.groupBy("g", "field").agg(F.max("cur").alias("top"), F.min_by("o", F.when(F.col("cur").isNotNull(), F.struct((-F.col("cur")).alias("a"), "k"))).alias("top_o"), F.collect_set(F.when(F.col("cur").isNull(), F.col("o"))).alias("free"))
        beaten = F.exists("free", lambda m: later(F.col("o"), m)) | F.coalesce(F.col("cur").isNull() & later(F.col("o"), F.col("top_o")), F.lit(False))
        stale = F.coalesce(F.col("cur") < F.col("top"), F.lit(False)) | F.exists("free", lambda m: F.coalesce(F.col("cur").isNotNull() & later(F.col("top_o"), m), F.lit(False)))
        best = placed.join(top, ["g", "field"]).where(~F.when(F.col("cur").isNull(), beaten).otherwise(stale))
        current = tied.where("not open").select(*long.columns).unionByName(best.select(*long.columns))
    choice = F.min(F.struct("r", F.col("cur").isNull().alias("free"), (-F.col("cur")).alias("cur"), "k", "value"))
    out = current.groupBy("g", "field").agg(choice.alias("m")).join(n, "g")
    return out.select(F.col("g").alias(group), "field", F.col("m.k").alias(key), F.col("m.value").alias("value"), "n_records")
