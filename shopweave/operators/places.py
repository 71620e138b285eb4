"""Places of rows in a total order, without a task that holds all rows of a group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopweave.session import new_path


def stored(df: DataFrame, tag: str) -> DataFrame:
    """df as a table in the shared folder, read again: what is read twice is made once, and a lost executor costs only a reread."""
    df.write.parquet(path := new_path(df.sparkSession, tag))
    return df.sparkSession.read.schema(df.schema).parquet(path)


def placed(rows: DataFrame, groups: list[str], order: str) -> DataFrame:
    """rows, stored, with place (0, 1, 2... in their group, ascending in order, nulls first) and n, the rows of the group.

    Rows are dealt by ranges of (groups, order) and sorted where they are. A row's place is its own in its partition
    plus the rows of its group in partitions before, and only the counts per partition and group meet in a
    window: as many rows for a group as it has partitions. Ties are dealt too, by where they were
    read, so neither a frequent group nor a frequent value fills a task. Null groups are groups. rows should be a stored table, since
    finding the ranges reads it once more.
    """
    own_columns = [c for c in rows.columns if c not in ("place", "n")]
    keyed = rows.select(*own_columns, F.struct(*groups).alias("__group"), F.monotonically_increasing_id().alias("__read"))
    keys = ["__group", order, "__read"]
    # an id holds the partition above bit 33 and counts the rows of the partition below
    count = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    dealt = stored(keyed.repartitionByRange(*keys).sortWithinPartitions(*keys).select(*own_columns, "__group", F.spark_partition_id().alias("__part"), count.alias("__at")), "placed")
    parts = dealt.groupBy("__group", "__part").agg(F.count("*").alias("rows"), F.min("__at").alias("first"))
    own = Window.partitionBy("__group")
    before = F.coalesce(F.sum("rows").over(own.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = parts.select("__group", "__part", (before - F.col("first")).alias("__start"), F.sum("rows").over(own).alias("n"))
    # the struct itself is never null, so groups with null members meet
    return dealt.join(starts, ["__group", "__part"]).select(*own_columns, (F.col("__start") + F.col("__at")).alias("place"), "n")
