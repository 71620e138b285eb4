"""Ticket statistics and duplicate checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .places import placed, stored


def find_duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """All rows whose key occurs more than once; null keys compare as equal. Counts are aggregated first, so a frequent key is no bottleneck."""
    twice = df.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(F.count("*").alias("__n")).filter("__n > 1")
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return df.join(twice, same, "left_semi")


def tickets_by_agent(tickets: DataFrame, status: str | None = None) -> DataFrame:
    """Rows (one per collaborator, not tickets) and distinct tickets per agent and status; with status, per agent for that one. Most first."""
    known = tickets.filter("assignee_id IS NOT NULL")
    by = ["assignee_id", "status"]
    if status is not None:
        known, by = known.filter(F.col("status") == status), ["assignee_id"]
    return known.groupBy(*by).agg(F.count("*").alias("n_tickets"), F.count_distinct("id").alias("n_distinct")).orderBy(F.desc("n_tickets"), *by)


def duration_box_stats(tickets: DataFrame, value: str = "ticket_duration_min") -> DataFrame:
    """Per agent and status: n, lower whisker, quartiles, upper whisker, outliers of the durations of tickets that are assigned or not new.

    Quartiles are interpolated; whiskers end at the last value within 1.5 times the
    box; collaborator and follower columns are left out and equal rows count once. Quartiles are
    picked by the places of the values, which are dealt by ranges, so no task holds the values of an agent.
    An agent without any duration has n = 0 and null quartiles.
    """
    kept = [c for c in tickets.columns if c != "collaborator_id" and not c.startswith("follower_ids")]
    by = ["assignee_id", "status"]
    once = tickets.filter(F.col("assignee_id").isNotNull() | (F.col("status") != "new")).select(*kept).distinct()
    values = stored(once.select(*by, F.col(value).alias("x")), "durations")
    names = {"q1": 0.25, "median": 0.5, "q3": 0.75}

    def quartile(p: float) -> Column:
        at = (F.col("n") - 1) * p
        low, high = (F.max(F.when(F.col("place") == r(at), F.col("x"))) for r in (F.floor, F.ceil))
        return low + F.max(at - F.floor(at)) * (high - low)

    known = placed(values.filter("x IS NOT NULL"), by, "x")
    boxes = known.groupBy(*by).agg(*[quartile(p).alias(q) for q, p in names.items()]).select(F.struct(*by).alias("g"), *names)
    x, low, high = F.col("x"), F.col("q1"), F.col("q3")
    inside = (x >= low - 1.5 * (high - low)) & (x <= high + 1.5 * (high - low))
    # values are counted before they meet the boxes, so a frequent one is one row
    counts = values.groupBy(*by, "x").agg(F.count("*").alias("c"))
    both = counts.join(boxes, F.struct(*by) == F.col("g"), "left")
    return both.groupBy(*by).agg(
        F.coalesce(F.sum(F.when(x.isNotNull(), F.col("c"))), F.lit(0)).alias("n"), F.min(F.when(inside, x)).alias("whisker_low"), *[F.first(q).alias(q) for q in names],
        F.max(F.when(inside, x)).alias("whisker_high"), F.coalesce(F.sum(F.when(~inside, F.col("c"))), F.lit(0)).alias("outliers"))
