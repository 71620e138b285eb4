"""Mixing sources to target weights by pivotal dependent rounding.

DataFrame functions only. Every document of a source has the same expected number
of copies; the whole part is certain, the fraction is rounded so that the words
taken from each source stay near its target.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import stored, uniform

#: Below this a probability counts as 0, and above 1 minus this as 1.
TINY = 1e-9


def word_count(text: Column) -> Column:
    r"""Number of maximal runs of anything but the blanks \x20 and \x09-\x0D; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(units: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Per source of units(source, size): source_size, target, rate = target / source_size.

    Sources by code point, null last, get the weights in turn and share
    share * all sizes; a target stops at most * source_size and the excess goes to
    the others by weight. With caps sorted by cap / weight, what one unit of weight
    gets when all before are capped is largest at the true level, so a running sum
    and a maximum give the result of resharing until none is above.
    """
    if share > most:
        raise ValueError("share must not exceed most: the targets could not be met")
    sums = units.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = sums.withColumn("weight", w).withColumn("cap", F.col("source_size") * float(most))
    before = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (share * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    target = F.least(F.col("cap"), F.max("level").over(everything) * F.col("weight"))
    return (
        ranked.withColumn("level", level).withColumn("target", target)
        .select("source", "source_size", "target", F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0)).alias("rate"))
    )


_KEY = ("size", "doc_id", "key", "no")


def _pivot(units: Column, seed: int) -> Column:
    """Fold an ordered array of (size, doc_id, key, no, p): (carried unit, decided array of (size, doc_id, key, no, pick)).

    At each step the carried unit and the next one meet; at random, with both
    expectations kept, one gives all it can to the other, so one becomes 0 or 1.
    """
    decided = "array<struct<size:bigint,doc_id:bigint,key:bigint,no:bigint,pick:int>>"
    of = lambda x: [x[n].alias(n) for n in _KEY]

    def meet(state: Column, x: Column) -> Column:
        a = state["unit"]
        total = a["p"] + x["p"]
        low = total < 1
        # the chance that a is decided now: to 0 if the two together are below 1, else to 1
        chance = F.when(low, F.when(total > 0, x["p"] / total).otherwise(1.0)).otherwise((1 - x["p"]) / (2 - total))
        stops = uniform(*of(a), *of(x), seed=seed) < chance
        pick = F.when(low, 0).otherwise(1).alias("pick")
        rest = F.when(low, total).otherwise(total - 1).alias("p")
        out = F.when(stops, F.struct(*of(a), pick)).otherwise(F.struct(*of(x), pick))
        return F.struct(F.when(stops, F.struct(*of(x), rest)).otherwise(F.struct(*of(a), rest)).alias("unit"), F.concat(state["decided"], F.array(out)).alias("decided"))

    start = F.struct(F.struct(*of(units[0]), units[0]["p"].alias("p")).alias("unit"), F.array().cast(decided).alias("decided"))
    return F.aggregate(F.slice(units, 2, F.greatest(F.size(units) - 1, F.lit(0))), start, meet)


def _numbered(counted: DataFrame, n: str, step: int = 10_000) -> DataFrame:
    """Each row of counted as often as its column n says, with no from 0 up in its place; many numbers of one row are dealt to many tasks."""
    parts = counted.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(n) - 1) / step)))).filter(F.col(n) > 0)
    parts = parts.repartition(F.xxhash64(*[c for c in counted.columns], "part"))
    first = F.col("part") * step
    return parts.withColumn("no", F.explode(F.sequence(first, F.least(first + step, F.col(n)) - 1))).drop("part", n)


def pivotal_round(units: DataFrame, seed: int = 0, fan_in: int = 64) -> DataFrame:
    """Round units(source, doc_id, size, p) to picks 0 or 1: source, doc_id, size, key, no, pick.

    A reduction tree: units of a source and size class meet in hashed groups of about
    fan_in, each group leaves one unit undecided, and those meet again in ever wider
    groups, at last one a source. Like sizes meet first, so what a pick shifts in
    words stays small. Each level is written to the shared folder; the levels'
    tables shrink by fan_in. Columns key and no tell units apart that share all else; without them such units share a group.
    """
    units = units.withColumns({c: F.lit(0).cast("long") for c in ("key", "no") if c not in units.columns})
    total = units.count()
    bits = max(0, math.ceil(math.log2(max(total, 1) / fan_in)))
    step = max(1, int(math.log2(fan_in)))
    unit = F.struct(*_KEY, "p")
    left = units.select(
        "source", F.floor(F.log(F.col("size") + F.lit(1.0)) * 8).cast("int").alias("size_class"),
        F.shiftrightunsigned(F.xxhash64(F.lit(seed), *_KEY), 64 - bits).alias("block") if bits else F.lit(0).cast("long").alias("block"),
        unit.alias("unit"),
    )
    levels = [(0, bits)] + [(0, b) for b in range(bits - step, 0, -step)] + ([(0, 0)] if bits else []) + [(3, 0), (6, 0), (31, 0)]
    done = []
    for n, (drop, keep) in enumerate(levels):
        grouped = left.groupBy(
            "source", F.shiftright("size_class", drop).alias("size_class"),
            (F.shiftright("block", bits - keep) if keep else F.lit(0).cast("long")).alias("block_now"),
        ).agg(F.sort_array(F.collect_list("unit")).alias("units"), F.min("block").alias("block"))
        got = grouped.select("source", "size_class", "block", _pivot(F.col("units"), seed + n + 1).alias("got"))
        got = stored(got, f"mix-level{n}")
        done.append(got.select("source", F.explode("got.decided").alias("x")).select("source", *[f"x.{c}" for c in _KEY], "x.pick"))
        left = got.select("source", "size_class", "block", F.col("got.unit").alias("unit"))
    p = F.col("unit.p")
    pick = F.when(p <= TINY, 0).when(p >= 1 - TINY, 1).otherwise((uniform(*[F.col(f"unit.{c}") for c in _KEY], seed=seed) < p).cast("int"))
    out = left.select("source", *[f"unit.{c}" for c in _KEY], pick.alias("pick"))
    for x in done:
        out = out.unionByName(x)
    return out


def mix_sources(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: int = 0, fan_in: int = 64) -> DataFrame:
    """Copies per row: source, doc_id, size, key, source_size, target, copies, taken = copies * size.

    docs needs doc_id, text and source. Null text has size 0, null source is a source
    of its own. key is a hash of all columns of the row; rows that are equal in all of them are numbered and each is rounded for itself, so they may differ by one
    copy. No document gets more than ceil(most) copies; an empty table gives none.
    """
    rows = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), _row_key(docs).alias("key"))
    units = stored(rows.groupBy("doc_id", "source", "size", "key").agg(F.count("*").alias("rows")), "mix-counted")
    units = stored(_numbered(units, "rows"), "mix-units")
    targets = stored(source_targets(units, weights, share, most), "mix-targets")
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    rated = units.join(targets, same(units, targets)).select(units["source"], *_KEY, (F.col("rate") - F.floor("rate")).alias("p"))
    picks = pivotal_round(rated, seed, fan_in)
    out = picks.join(targets, same(picks, targets)).select(
        picks["source"], "doc_id", "size", "key", "source_size", "target", (F.floor("rate") + F.col("pick")).alias("copies"))
    return out.withColumn("taken", F.col("copies") * F.col("size"))


def _row_key(docs: DataFrame) -> Column:
    return F.xxhash64(*[F.col(f"`{c}`") for c in sorted(docs.columns)])


def repeat_documents(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """Every row of docs as often as mixed = mix_sources(docs) takes it: all columns of docs, rows of 0 copies gone.

    Rows are told apart by the hash of all their columns. Rows that are equal share what is taken of them
    evenly; one of them has the remainder.
    """
    taken = mixed.groupBy("key").agg(F.sum("copies").cast("long").alias("__taken"), F.count("*").alias("__rows")).filter("__taken > 0").withColumnRenamed("key", "__key")
    keyed = docs.withColumn("__key", _row_key(docs)).join(taken, "__key")
    each = keyed.withColumn("__n", F.floor(F.col("__taken") / F.col("__rows"))).filter("__n > 0")
    each = each.withColumn("__no", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__n"))))
    left = keyed.filter("__rows > 1 AND __taken % __rows > 0").dropDuplicates(["__key"]).withColumn("__n", F.col("__taken") % F.col("__rows"))
    return each.select(*docs.columns).unionByName(_numbered(left.select(*docs.columns, "__n"), "__n").select(*docs.columns))
