"""Importance resampling: documents drawn by how much likelier their words are in a target's text than in the corpus."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .ranking import numbered
from .shared import stored

#: Pivots a pass compares all keys with, and keys that are few enough to be sorted by the driver's query.
PIVOTS, FEW = 31, 1_000
#: Runs of digits, small letters and anything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The words of text, A-Z in lower case; none for null."""
    lower = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.coalesce(F.regexp_extract_all(lower, F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def buckets(text: Column, longest: int, size: int) -> Column:
    """The bucket of every run of 1 to longest words of text: crc32 of the run, joined by one space, modulo size."""

    def hashed(run: Column) -> Column:
        return (F.crc32(run.cast("binary")) % size).cast("int")

    def runs(w: Column, k: int) -> Column:
        starts = F.sequence(F.lit(1), F.size(w) - k + 1)
        return F.when(F.size(w) >= k, F.transform(starts, lambda i: hashed(F.array_join(F.slice(w, i, k), " ")))).otherwise(F.array().cast("array<int>"))

    found = words(text)
    if longest == 1:
        return F.transform(found, hashed)
    return F.element_at(F.transform(F.array(found), lambda w: F.concat(*[runs(w, k) for k in range(1, longest + 1)])), 1)


def _counts(rows: DataFrame, name: str) -> DataFrame:
    return rows.select(F.explode("buckets").alias("b")).groupBy("b").agg(F.count("*").alias(name))


def gains(spark: SparkSession, corpus: DataFrame, target: DataFrame, size: int) -> DataFrame:
    """One row: gains, an array with floor(1000 ln(share of the bucket in target / in corpus)) for each of the size buckets, all counts plus one.

    Counts are taken map-side first, so at most size rows leave each task; the sums of all buckets are whole numbers.
    """
    both = spark.range(size).select(F.col("id").cast("int").alias("b")).join(_counts(corpus, "s"), "b", "left").join(_counts(target, "t"), "b", "left").select("b", *[F.coalesce(c, F.lit(0)).alias(c) for c in "st"])
    counts = both.agg(F.array_sort(F.collect_list(F.struct("b", "s", "t"))).alias("c"), F.sum("s").cast("double").alias("S"), F.sum("t").cast("double").alias("T"))
    share = lambda x: (x["t"] + 1).cast("double") * (F.col("S") + size) / ((x["s"] + 1).cast("double") * (F.col("T") + size))
    return counts.select(F.transform("c", lambda x: F.floor(F.log(share(x)) * 1000)).alias("gains"))


def gumbel(doc_id: Column, seed: int) -> Column:
    """floor(-1000 ln(-ln(u))) for a number u in (0, 1) that depends on the seed and the id alone; an id that is null counts as empty."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.log(-F.log((h + 0.5) / 4294967296.0)) * -1000)


def _before(key: list[str], pivot: list[object]) -> Column:
    """Whether a row's key, all columns ascending and without nulls, comes before pivot."""
    out = F.lit(False)
    for c, v in reversed(list(zip(key, pivot, strict=True))):
        out = (F.col(c) < F.lit(v)) | ((F.col(c) == F.lit(v)) & out)
    return out


def kth_key(rows: DataFrame, key: list[str], k: int) -> list[object]:
    """The k-th (from 1) of rows by key, whose columns are numbers, never null, and together differ from row to row.

    Distributed quickselect: each pass draws pivots from the keys that are left, by the hash of the
    key, and counts in one aggregate how many keys come before each and equal it; the k-th then is a
    pivot or lies between two. Some 30-fold fewer keys are left after a pass; the last few
    are sorted. Only pivots and counts reach the driver. There must be k rows.
    """
    low: list[object] | None = None
    high: list[object] | None = None
    before, left = 0, rows.count()

    def inside() -> DataFrame:
        some = rows
        if low is not None:
            some = some.filter(~_before(key, low) & ~_equal(key, low))
        return some if high is None else some.filter(_before(key, high))

    for turn in range(1_000):
        if left <= FEW:
            found = inside().orderBy(*key).limit(k - before).collect()
            return [found[-1][c] for c in key]
        drawn = inside().orderBy(F.xxhash64(F.lit(turn), *key), *key).limit(PIVOTS).collect()
        pivots = sorted([r[c] for c in key] for r in drawn)
        sums = [F.sum(_before(key, p).cast("long")).alias(f"b{i}") for i, p in enumerate(pivots)] + [F.sum(_equal(key, p).cast("long")).alias(f"e{i}") for i, p in enumerate(pivots)]
        got = inside().agg(*sums).first()
        upto = 0
        for i, p in enumerate(pivots):
            if k <= before + got[f"b{i}"]:
                high, left = p, got[f"b{i}"] - upto
                break
            upto = got[f"b{i}"] + got[f"e{i}"]
            if k <= before + upto:
                return p
            low = p
        else:
            left -= upto
        before += upto
    raise ValueError("keys are not distinct")


def _equal(key: list[str], pivot: list[object]) -> Column:
    out = F.lit(True)
    for c, v in zip(key, pivot, strict=True):
        out = out & (F.col(c) == F.lit(v))
    return out


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20, longest: int = 1, size: int = 10_000, seed: int = 2024, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_words, n_features, weight, score of every row of docs, and rank (1, 2...) of those that are drawn, else null.

    Drawn are the floor(percent / 100 of the rows with least_words words) highest scores among these, ties to the
    smaller doc_id (null last), then by the text's hash. weight sums the gains of a text's features; score adds Gumbel noise,
    so that the draw is one without replacement, by likelihood ratio. Null and empty texts have no features
    and weight 0. Equal rows differ by where they were read and are drawn one by one. Without documents
    there are no rows; without target text all shares of the target are alike.

    Texts are read once, into a table of buckets; gains are one array of size numbers, so they are sent to all tasks. The draw's
    limit is found by kth_key, and only the rows within it are sorted, by ranges.
    """
    spark = docs.sparkSession
    made = docs.select(F.col(doc_id).alias("id"), F.xxhash64(text).alias("h"), F.size(words(F.col(text))).alias("n_words"), buckets(F.col(text), longest, size).alias("buckets"))
    if longest == 1:
        made = made.withColumn("n_words", F.size("buckets"))
    held = stored(made, "resample-buckets")
    wanted = target.select(buckets(F.col(text), longest, size).alias("buckets"))
    table = F.broadcast(gains(spark, held, wanted, size))
    weight = F.aggregate("buckets", F.lit(0).cast("long"), lambda a, b: a + F.get("gains", b))
    scored = held.crossJoin(table).select("id", "h", F.col("n_words").cast("long").alias("n_words"), F.size("buckets").cast("long").alias("n_features"), weight.alias("weight"))
    scored = scored.withColumn("score", F.col("weight") + gumbel(F.col("id"), seed))
    # the key of the draw: all ascending, no nulls
    keyed = stored(scored.withColumns({"down": -F.col("score"), "none": F.col("id").isNull().cast("int"), "by": F.coalesce(F.col("id"), F.lit(0)), "at": F.monotonically_increasing_id()}), "resample-scores")
    key = ["down", "none", "by", "h", "at"]
    able = keyed.filter(F.col("n_words") >= least_words)
    draws = able.count() * percent // 100
    out = [F.col("id").alias(doc_id), "n_words", "n_features", "weight", "score"]
    if draws == 0:
        return keyed.select(*out, F.lit(None).cast("long").alias("rank"))
    last = kth_key(able, key, draws)
    drawn = (F.col("n_words") >= least_words) & (_before(key, last) | _equal(key, last))
    ranked = numbered(stored(keyed.filter(drawn), "resample-drawn"), key, tag="resample-ranks")
    return keyed.filter(~drawn).select(*out, F.lit(None).cast("long").alias("rank")).unionByName(ranked.select(*out, (F.col("place") + 1).alias("rank")))
