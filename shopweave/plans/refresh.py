"""One source's refresh: read the master, take the due window of what has landed, clean, merge, store."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shopweave.operators.upsert import in_window, next_window, replace_window, upsert_latest, upsert_placed
from shopweave.session import new_path
from shopweave.sources.masters import day_of, held_days, key_days, manifest, read_master, touched_days, write_master

WAYS = ("upsert", "append", "replace")
#: Versions of a master that a refresh leaves behind, for readers that have begun.
KEEP = 3
#: Rows of a day from which on it is dealt to several tasks.
PART = 100_000

Merge = Callable[[DataFrame, DataFrame], DataFrame]


def merge_into(spark: SparkSession, master: str, new: DataFrame, merge: Merge, keys: list[str], by: str | None = None, days: list[str] | None = None) -> list[str] | None:
    """Store merge(new, old) as the next version of the master at path; new is a stored table. The days that were written, None for all.

    Where the master is stored by the day of column by, and its last version was written for the same keys, old holds only the days that
    change: days, where these are known, else those of new rows and of their keys (touched_days). The first merge by these
    keys goes over the whole master, so that from then on it holds each key once, as a master stored whole does.
    """
    of = manifest(spark, master)
    keyed = keys if all(k in {*new.columns, *(of.schema.fieldNames() if of.schema else ())} for k in keys) else []
    known = by is not None and of.by == by and of.keys == keyed
    if not known:
        write_master(merge(new, read_master(spark, master)), master, by, keys=keyed, keep=KEEP, unit=of.unit if of.by == by else "day")
        return None
    touched = sorted({*(days or []), *touched_days(spark, master, new, [] if days is not None else keyed)})
    if touched:
        write_master(merge(new, read_master(spark, master, touched)), master, by, touched, keyed, new if keyed else None, KEEP, unit=of.unit)
    return touched


def upsert_into(spark: SparkSession, master: str, new: DataFrame, keys: list[str], updated: str | None = None, by: str | None = None) -> list[str] | None:
    """upsert_latest of new, a stored table, into the master at path; the days that were written, None for all.

    A master by day that holds each key once is not gathered by key: its directory tells where the keys of new are.
    """
    of = manifest(spark, master)
    kinds = {f.name: f.dataType for f in of.schema.fields} if of.schema else {}
    if by is not None and of.by == by and keys and of.keys == keys and all(k in new.columns and kinds.get(k) == new.schema[k].dataType for k in keys):
        key_days(spark, master, new, keys).write.parquet(found := new_path(spark, "places"))
        places = spark.read.parquet(found)
        touched = sorted({*touched_days(spark, master, new, []), *(r["day"] for r in places.select("day").distinct().collect())})
        if touched:
            rows = [of.rows.get(d, 0) for d in touched]
            # a day of many rows is dealt to as many tasks as its share asks for
            parts = max(1, min(-(-max(rows) // PART), -(-int(spark.conf.get("spark.sql.shuffle.partitions")) * max(rows) // max(1, sum(rows)))))
            merged = upsert_placed(new, read_master(spark, master, touched), keys, places, lambda df: day_of(df, by, of.unit), parts, updated)
            write_master(merged, master, by, touched, keys, new, KEEP, unit=of.unit, dealt=True)
        return touched
    return merge_into(spark, master, new, lambda a, b: upsert_latest(a, b, keys, updated), keys, by)


def refresh_source(spark: SparkSession, master: str, landed: DataFrame, clean: Callable[[DataFrame], DataFrame], how: str, date_col: str,
                   today: dt.date, keys: list[str] | None = None, updated: str | None = None, overlap: int = 2, by: str | None = None) -> dict[str, int]:
    """Bring the master at path up to date with landed rows of the due window; {'new': rows merged in, 'total': rows stored}.

    how: 'upsert' (by keys), 'append' (rows later than the last; by keys, if given), 'replace' (the window from its start to today). by names the
    column by whose day the master is stored; then only days that change are read and written anew. Either way the
    result is the same: keys may be several and null, rows without a date or after today stay.
    """
    if how not in WAYS:
        raise ValueError(f"unknown way to refresh: {how}")
    of, keys = manifest(spark, master), keys or []
    # by the day of date_col, the last day alone tells how far the master has come
    last = [max((d for d in of.held if d and d != "none"), default="none")] if of.by == date_col else None
    old = read_master(spark, master, last)
    window = next_window(old, date_col, today, overlap).first()
    if not window["due"]:
        return {"new": 0, "total": of.total}
    start, end = window["start_date"], window["end_date"]
    day = F.to_date(date_col)
    seen = Observation()
    due = clean(landed).filter((day >= F.lit(start)) & (day <= F.lit(end))).observe(seen, F.count("*").alias("n"))
    due.write.parquet(staged := new_path(spark, "due"))
    new = spark.read.schema(due.schema).parquet(staged)
    if how == "upsert":
        upsert_into(spark, master, new, keys, updated, by)
    elif how == "append":
        latest = old.agg(F.max(date_col).alias("at")).first()["at"]
        later = new if latest is None else new.filter(F.col(date_col) > F.lit(latest))
        merge_into(spark, master, later, lambda a, b: upsert_latest(a, b, keys, date_col), keys, by)
    elif not new.isEmpty():
        days = None
        if by is not None:
            days = held_days(of, start, end) if by == date_col else [r["d"] for r in old.filter(in_window(date_col, start, end)).select(day_of(old, by, of.unit).alias("d")).distinct().collect()]
        merge_into(spark, master, new, lambda a, b: replace_window(b, a, date_col, start, end), [], by, days)
    return {"new": seen.get["n"], "total": manifest(spark, master).total}
