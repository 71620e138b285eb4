"""Master tables in numbered versions: whole or by day, with a directory of the days that hold a key, and retention."""

from __future__ import annotations

import datetime as dt
import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopweave.session import children, new_path, remove

#: Columns that a stored master has besides its own: the version that wrote a row, and its day; and a key's bucket in the directory.
_VERSION, _DAY, _BUCKET = "__version", "__day", "__bucket"
#: Buckets of the directory, and its parts before it is written anew.
BUCKETS, PARTS = 64, 16


@dataclass
class Manifest:
    """What one version of a master is made of. unit: whether a "day" of it is a day or a month; held: which version's files hold each day (None: all); rows: their rows; keys: that are unique in it, None if unknown; directory: its parts."""

    number: int = 0
    by: str | None = None
    unit: str = "day"
    schema: T.StructType | None = None
    keys: list[str] | None = None
    directory: list[str] = field(default_factory=list)
    held: dict[str | None, str] = field(default_factory=dict)
    rows: dict[str | None, int] = field(default_factory=dict)

    @property
    def total(self) -> int:
        return sum(self.rows.values())


def _numbers(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete versions, ascending."""
    return sorted(int(n.removeprefix("part=")) for n in children(spark, f"{path}/_manifest") if n.startswith("part="))


def manifest(spark: SparkSession, path: str, number: int | None = None) -> Manifest:
    """The latest (or that) version of the master at path; of number 0 where there is none yet. Only this version's own file is read."""
    number = number or max(_numbers(spark, path), default=0)
    if not number:
        return Manifest()
    rows = spark.read.schema(f"{_DAY} string, held string, n bigint, head string").parquet(f"{path}/_manifest/part={number}").collect()
    head = next(json.loads(r["head"]) for r in rows if r["head"])
    days = [r for r in rows if r["held"]]
    return Manifest(number, head["by"], head["unit"], T.StructType.fromJson(head["schema"]), head["keys"], head["directory"], {r[_DAY]: r["held"] for r in days}, {r[_DAY]: r["n"] for r in days})


def label(at: Column, unit: str = "day") -> Column:
    """The day, or first day of the month, of a date or time, as text."""
    day = at.cast("date")
    return (F.trunc(day, "month") if unit == "month" else day).cast("string")


def day_of(df: DataFrame, by: str, unit: str = "day") -> Column:
    """The day (or month, by unit), as text, by which a row of df is stored; 'none' for unknown. A whole number, such as a bucket, is stored like a day."""
    whole = isinstance(df.schema[by].dataType, T.IntegralType)
    return F.coalesce(F.col(by).cast("string") if whole else label(F.col(by), unit), F.lit("none"))


def _dealt(df: DataFrame, by: str, unit: str) -> DataFrame:
    """df by day; adaptive execution splits a frequent day over several tasks and puts rare ones together."""
    return df.withColumn(_DAY, day_of(df, by, unit)).hint("rebalance", _DAY)


def write_master(df: DataFrame, path: str, by: str | None = None, replaces: list[str] | None = None, keys: list[str] | None = None, added: DataFrame | None = None, keep: int | None = None, base: int | None = None,
                 unit: str = "day", dealt: bool = False) -> int:
    """Store df as the next version of the master at path and return its number.

    With by, a date or time column, rows are stored by day, or by month where unit says so, since days should hold enough rows to be worth a file each (what
    is said of days holds of months then, named by their first day). Of the version before all days stay but those
    in replaces (as text, 'none' for unknown) and those that df has; without replaces nothing of it stays.
    df may be computed from the current version, which is never overwritten; readers see the
    new one only when it is complete. Versions are numbered, so clocks play no part, and two
    writers of one number cannot both succeed.

    keys says that df's rows (with those that stay) are unique by these. A master by day then has a directory: (hash of a
    key, day) in hash buckets, made of df, or, where replaces is given, the former one and the rows added. It may
    name days that no longer hold a key, never lack one that does. With keep, what only versions before the last keep name is deleted. base is the version before, where that is not the latest. dealt says that
    df's partitions hold few days each, so that its rows can be written where they are.
    """
    spark = df.sparkSession
    last = manifest(spark, path, base)
    next_one = Manifest(max(_numbers(spark, path), default=0) + 1, by, unit, df.schema, keys)
    now = new_path(spark, f"v{next_one.number}").rsplit("/", 1)[-1]  # what a writer that failed has left is not in the way
    target = f"{path}/data/{_VERSION}={now}"
    if by is None:
        df.write.parquet(target)
        next_one.held, next_one.rows = {None: now}, {None: spark.read.schema(df.schema).parquet(target).count()}
    else:
        (df.withColumn(_DAY, day_of(df, by, unit)) if dealt else _dealt(df, by, unit)).write.partitionBy(_DAY).parquet(target)
        new = {r[_DAY]: r["count"] for r in spark.read.schema(T.StructType([*df.schema.fields, T.StructField(_DAY, T.StringType())])).parquet(target).groupBy(_DAY).count().collect()}
        gone = {*new, *(last.held if replaces is None else replaces)}
        next_one.held = {d: v for d, v in last.held.items() if d not in gone} | dict.fromkeys(new, now)
        next_one.rows = {d: n for d, n in last.rows.items() if d not in gone} | new
        if replaces is not None and last.schema:  # what other days alone have stays a column
            next_one.schema = T.StructType([*df.schema.fields, *(f for f in last.schema.fields if f.name not in df.columns)])
        if keys:
            parts = last.directory if added is not None and replaces is not None and last.keys == keys and len(last.directory) < PARTS else []
            named = added if parts else _all_rows(spark, path, next_one, [*dict.fromkeys([*keys, by])])
            _write_keys(named, f"{path}/_keys/{_VERSION}={now}", keys, day_of(named, by, unit))
            next_one.directory = [*parts, now]
    rows = [(d, v, next_one.rows[d], None) for d, v in next_one.held.items()]
    head = {"by": by, "unit": unit, "schema": next_one.schema.jsonValue(), "keys": keys, "directory": next_one.directory}
    spark.createDataFrame([*rows, (None, None, None, json.dumps(head))], f"{_DAY} string, held string, n bigint, head string").coalesce(1).write.parquet(f"{path}/_manifest/part={next_one.number}")
    if keep:
        retain(spark, path, keep)
    return next_one.number


def _all_rows(spark: SparkSession, path: str, of: Manifest, columns: list[str] | None = None, days: list[str] | None = None) -> DataFrame:
    names = columns or of.schema.fieldNames()
    if None in of.held:
        return spark.read.schema(of.schema).parquet(f"{path}/data/{_VERSION}={of.held[None]}").select(*names)
    by_version: dict[str, list[str]] = {}
    for d, v in of.held.items():
        if days is None or d in days:
            by_version.setdefault(v, []).append(d)
    if not by_version:
        return spark.createDataFrame([], of.schema).select(*names)
    whole = T.StructType([*of.schema.fields, T.StructField(_VERSION, T.StringType()), T.StructField(_DAY, T.StringType())])
    # the folders of few days are named one by one; else those of whole versions, of which the filter leaves these days
    paths = [f"{path}/data/{_VERSION}={v}/{_DAY}={d}" for v, ds in by_version.items() for d in ds]
    if len(paths) > 64:
        paths = [f"{path}/data/{_VERSION}={v}" for v in by_version]
    wanted = F.lit(False)
    for v, ds in by_version.items():
        wanted = wanted | ((F.col(_VERSION) == v) & F.col(_DAY).isin(ds))
    return spark.read.schema(whole).option("basePath", f"{path}/data").parquet(*paths).filter(wanted).select(*names)


def read_master(spark: SparkSession, path: str, days: list[str] | None = None, number: int | None = None) -> DataFrame:
    """The latest complete version (or that of number) of the master at path; with days only the rows of these, whose folders alone are read. FileNotFoundError where there is none."""
    of = manifest(spark, path, number)
    if not of.number:
        raise FileNotFoundError(f"no master at {path}")
    return _all_rows(spark, path, of, days=days)


# ---- the directory of keys


def key_hash(keys: list[str]) -> Column:
    """One number for a key, nulls included; numbers count as their text, so that a column may become wider."""
    return F.xxhash64(*[F.col(f"`{k}`").cast("string") for k in keys])


def _bucket(h: Column) -> Column:
    return F.pmod(h, F.lit(BUCKETS)).cast("int")


def _write_keys(rows: DataFrame, path: str, keys: list[str], day: Column) -> None:
    found = rows.select(key_hash(keys).alias("h"), day.alias("day")).withColumn(_BUCKET, _bucket(F.col("h")))
    found.repartition(_BUCKET).distinct().sortWithinPartitions(_BUCKET, "h").write.partitionBy(_BUCKET).parquet(path)


def directory(spark: SparkSession, path: str, of: Manifest, buckets: list[int]) -> DataFrame:
    """h and day of the directory's rows in these buckets, whose folders alone are read."""
    rows = spark.read.schema(f"h bigint, day string, {_VERSION} string, {_BUCKET} int").parquet(f"{path}/_keys")
    return rows.filter(F.col(_VERSION).isin(of.directory) & F.col(_BUCKET).isin(buckets)).select("h", "day")


def key_days(spark: SparkSession, path: str, new: DataFrame, keys: list[str]) -> DataFrame:
    """The keys of new, a stored table, with each day that may hold them by the directory of the master at path; a day may come twice."""
    mine = new.select(*[F.col(f"`{k}`") for k in keys], key_hash(keys).alias("h")).distinct()
    buckets = [r["b"] for r in mine.select(_bucket(F.col("h")).alias("b")).distinct().collect()]
    return mine.join(directory(spark, path, manifest(spark, path), buckets), "h").drop("h")


def touched_days(spark: SparkSession, path: str, new: DataFrame, keys: list[str]) -> list[str]:
    """The days, as text, in which an upsert of new, a stored table, changes the master by day at path: those of new rows and, by the directory, those that may hold their keys now; nulls are equal. Of the master itself nothing is read."""
    of = manifest(spark, path)
    found = {r["day"] for r in new.select(day_of(new, of.by, of.unit).alias("day")).distinct().collect()}
    if keys:
        mine = new.select(key_hash(keys).alias("h")).distinct()
        buckets = [r["b"] for r in mine.select(_bucket(F.col("h")).alias("b")).distinct().collect()]
        found |= {r["day"] for r in directory(spark, path, of, buckets).join(mine, "h", "left_semi").select("day").distinct().collect()}
    return sorted(found)


# ---- retention


def retain(spark: SparkSession, path: str, keep: int) -> None:
    """Delete the versions before the last keep, and all files of theirs that these do not name; what a writer at work has written stays."""
    numbers = _numbers(spark, path)
    old, kept = numbers[:-keep], numbers[-keep:]
    if not old:
        return
    live = [manifest(spark, path, n) for n in kept]
    days = {(v, d) for m in live for d, v in m.held.items()}
    versions, parts = {v for v, _ in days}, {p for m in live for p in m.directory}
    past = lambda name: int(name.split("=", 1)[1][1:].split("-", 1)[0]) < kept[0]
    for n in old:
        remove(spark, f"{path}/_manifest/part={n}")
    for folder, named in (("data", versions), ("_keys", parts)):
        for name in children(spark, f"{path}/{folder}"):
            if not name.startswith(f"{_VERSION}=") or not past(name):
                continue
            version = name.split("=", 1)[1]
            if version not in named:
                remove(spark, f"{path}/{folder}/{name}")
            elif folder == "data" and (version, None) not in days:
                for day in children(spark, f"{path}/data/{name}"):
                    if day.startswith(f"{_DAY}=") and (version, day.split("=", 1)[1]) not in days:
                        remove(spark, f"{path}/data/{name}/{day}")


def changed_days(before: Manifest, now: Manifest) -> list[str | None] | None:
    """The days whose rows are not stored where they were in the version before; None, for all, if either is not stored by the same column."""
    if before.by is None or (before.by, before.unit) != (now.by, now.unit):
        return None
    return [d for d in {**before.held, **now.held} if before.held.get(d) != now.held.get(d)]


def held_days(of: Manifest, start: dt.date, end: dt.date) -> list[str]:
    """Days that a master holds, of which some lie from start to end."""
    first = start.replace(day=1) if of.unit == "month" else start
    return [d for d in of.held if d and d != "none" and str(first) <= d <= str(end)]
