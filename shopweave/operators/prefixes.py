"""Names for ids by prefix, for lookup tables of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_prefixes(df: DataFrame, ids: str, dim: DataFrame, out: str, key: str = "id", value: str = "name", longest: bool = False) -> DataFrame:
    """df with a column out: the name of the shortest (or longest) key of dim that the text of ids starts with, else that text; null for null.

    The shortest is what map_ids takes by 'prefix' from a table that fits it. Only lengths that
    keys have are cut from each distinct text, the pieces meet the keys by an equi-join, and
    names come back to the rows by their text, so no text is held against all keys. Rows of dim
    with a null are left out, of equal keys the smaller name counts; rows of df stay as they
    are, repeated ones too, and a column of the name out is replaced.
    """
    keys = dim.select(F.col(key).cast("string").alias("__k"), F.col(value).cast("string").alias("__v")).dropna().groupBy("__k").agg(F.min("__v").alias("__v"))
    # As many numbers as keys have lengths.
    lengths = sorted(keys.agg(F.collect_set(F.length("__k")).alias("n")).first()["n"])
    rows = df.withColumn("__t", F.col(ids).cast("string"))
    cut = F.filter(F.array(*map(F.lit, lengths)).cast("array<int>"), lambda n: n <= F.length("__t"))
    pieces = rows.select("__t").dropna().distinct().select("__t", F.explode(cut).alias("__n")).withColumn("__k", F.left("__t", F.col("__n")))
    pick = F.max_by if longest else F.min_by
    names = pieces.join(keys, "__k").groupBy("__t").agg(pick("__v", "__n").alias("__v"))
    return rows.join(names, "__t", "left").withColumn(out, F.coalesce("__v", "__t")).drop("__t", "__v")
