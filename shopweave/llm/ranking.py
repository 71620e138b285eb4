"""Places of rows in a total order, without a task that holds all rows of a group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import stored


def numbered(rows: DataFrame, order: list[str], group: str | None = None, tag: str = "numbered") -> DataFrame:
    """rows, stored, with place (0, 1, 2... within their group, ascending in the columns of order, nulls first) and n, the rows of the group.

    Rows are dealt by ranges of (group, order) and sorted where they are; a row's place is that in its
    partition plus the rows of its group in partitions before, of which there are as many
    as partitions. Equal rows are dealt by where they were read, so they fill no partition of
    their own. rows should be a stored table, since finding the ranges reads it once more.
    A null group is a group. Columns named place, n and those that begin with _ here are replaced.
    """
    own = [c for c in rows.columns if c not in ("place", "n", "_part", "_at", "_g", "_p", "_same", "_start")]
    # a group's range begins with its own column; without one all rows are one group
    keyed = rows.select(*own, (F.col(group) if group else F.lit(0)).alias("_g"), F.monotonically_increasing_id().alias("_at"))
    keys = ["_g", *order, "_at"]
    inside = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    dealt = stored(keyed.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumns({"_part": F.spark_partition_id(), "_at": inside}), tag)
    parts = dealt.groupBy("_part", "_g").agg(F.count("*").alias("c"), F.min("_at").alias("first"))
    whole = Window.partitionBy("_g")
    before = F.coalesce(F.sum("c").over(whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = parts.select(F.col("_part").alias("_p"), F.col("_g").alias("_same"), (before - F.col("first")).alias("_start"), F.sum("c").over(whole).alias("n"))
    both = dealt.join(starts, (F.col("_part") == F.col("_p")) & F.col("_g").eqNullSafe(F.col("_same")))
    return both.select(*own, (F.col("_start") + F.col("_at")).alias("place"), "n")
