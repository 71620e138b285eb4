"""The daily profit table kept up to date: only days that changed, and days that gain or lose a customer's first order, are computed anew."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopweave.operators import daily
from shopweave.plans.refresh import KEEP
from shopweave.session import children, new_path, remove, require
from shopweave.sources.masters import Manifest, _numbers, changed_days, label, manifest, read_master, write_master

#: Buckets of customers in the view's table of orders.
BUCKETS = 64
_CUSTOMER = ["customer_id", "order_id", "created_at"]
_PARTS = ("sales", "refunds", "spend")


def _last(spark: SparkSession, view: str) -> dict[str, int]:
    """Versions that the view has seen (items, returns, ads) and is made of (orders, firsts, and the daily parts); empty if there is none yet."""
    done = sorted(int(n.removeprefix("part=")) for n in children(spark, f"{view}/_seen"))
    return json.loads(spark.read.schema("seen string").parquet(f"{view}/_seen/part={done[-1]}").first()["seen"]) if done else {}


def _stored(df: DataFrame) -> DataFrame:
    df.write.parquet(path := new_path(df.sparkSession, "view"))
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _same(a: DataFrame, b: DataFrame, columns: list[str]) -> Column:
    """Equal columns, nulls included."""
    out = F.lit(True)
    for c in columns:
        out = out & a[c].eqNullSafe(b[c])
    return out


def _bucket() -> Column:
    return F.pmod(F.xxhash64("customer_id"), F.lit(BUCKETS)).cast("int")


class _View:
    """One refresh: what it has seen before, and how it reads and writes the view's own masters."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.seen = spark, path, _last(spark, path)
        self.now = dict(self.seen)

    def changes(self, name: str, master: str) -> tuple[list[str] | None, Manifest]:
        """Days in which master has changed since the view saw it, None for all: at first, or where it no longer has the version seen."""
        of = manifest(self.spark, master)
        if not of.number:
            raise FileNotFoundError(f"no master at {master}")
        self.now[name] = of.number
        number = self.seen.get(name)
        return (changed_days(manifest(self.spark, master, number), of) if number in _numbers(self.spark, master) else None), of

    def read(self, part: str, days: list[str] | None = None) -> DataFrame:
        return read_master(self.spark, f"{self.path}/{part}", days, self.now[part])

    def write(self, part: str, df: DataFrame, by: str, days: list[str] | None, unit: str = "day") -> None:
        self.now[part] = write_master(df, f"{self.path}/{part}", by, days, keep=2 * KEEP, base=self.seen.get(part), unit=unit)

    def commit(self) -> None:
        done = sorted(int(n.removeprefix("part=")) for n in children(self.spark, f"{self.path}/_seen"))
        self.spark.createDataFrame([(json.dumps(self.now),)], "seen string").coalesce(1).write.parquet(f"{self.path}/_seen/part={done[-1] + 1 if done else 1}")
        for n in done[:-1]:
            remove(self.spark, f"{self.path}/_seen/part={n}")


def _moved_firsts(view: _View, old: DataFrame, new: DataFrame) -> DataFrame:
    """Customers whose first order has moved: before and after, its place; and the view's table of orders is brought up to date.

    old and new are the items of the changed days. Only the buckets of customers whose orders changed are read and written.
    """
    orders = lambda items, n: items.select(*_CUSTOMER).distinct().withColumn("n", F.lit(n))
    change = _stored(orders(old, -1).unionByName(orders(new, 1)).groupBy(*_CUSTOMER).agg(F.sum("n").alias("n")).filter("n <> 0"))
    buckets = [str(r["b"]) for r in change.select(_bucket().alias("b")).distinct().collect()]
    known = view.read("orders", buckets).drop("bucket") if "orders" in view.now else change.select(*_CUSTOMER).limit(0)
    both = known.withColumns({"n": F.lit(1), "was": F.lit(1)}).unionByName(change.withColumn("was", F.lit(0)))
    now = _stored(both.groupBy(*_CUSTOMER).agg(F.max("was").alias("was"), (F.sum("n") > 0).alias("is")))
    place = daily.place()
    firsts = now.groupBy("customer_id").agg(F.min(F.when(F.col("was") == 1, place)).alias("before"), F.min(F.when(F.col("is"), place)).alias("after"))
    view.write("orders", now.filter("is").select(*_CUSTOMER, _bucket().alias("bucket")), "bucket", buckets if "orders" in view.seen else None)
    return _stored(firsts.filter(~F.col("before").eqNullSafe(F.col("after"))))


def _day(place: str, unit: str) -> Column:
    return F.when(F.col(place).isNotNull(), F.coalesce(label(F.col(f"{place}.created_at"), unit), F.lit("none")))


def _refresh_sales(view: _View, items: str, exclude_cancelled: bool) -> int:
    days, of = view.changes("items", items)
    if of.by != "created_at":
        raise ValueError("items must be stored by the day of created_at")
    if days == []:
        return 0
    if days is None:  # from the start
        for part in ("orders", "firsts", "sales"):
            view.seen.pop(part, None)
            view.now.pop(part, None)
    spark = view.spark
    counted = lambda df: daily.counted(df, exclude_cancelled)
    new = counted(read_master(spark, items, days, of.number))
    require(new, *daily.SALES)
    old = counted(read_master(spark, items, days, view.seen["items"])) if days is not None else new.limit(0)
    moved = _moved_firsts(view, old, new)
    gains = [r["d"] for r in moved.select(F.explode(F.array(_day("before", of.unit), _day("after", of.unit))).alias("d")).filter("d IS NOT NULL").distinct().collect()]
    after = moved.filter("after IS NOT NULL").select("customer_id", "after.order_id", "after.created_at")
    if "firsts" in view.now:
        stay = view.read("firsts", gains)
        after = stay.join(moved.select("customer_id"), stay["customer_id"].eqNullSafe(moved["customer_id"]), "left_anti").unionByName(after)
    view.write("firsts", after, "created_at", gains if "firsts" in view.seen else None, of.unit)

    again = None if days is None else sorted({*days, *gains})
    sold = counted(read_master(spark, items, again, of.number))
    firsts = view.read("firsts", again).select(*[F.col(c).alias(f"first_{c}") for c in _CUSTOMER])
    is_first = F.lit(True)
    for c in _CUSTOMER:
        is_first = is_first & F.col(c).eqNullSafe(F.col(f"first_{c}"))
    flagged = sold.join(firsts.withColumn("is_nc", F.lit(True)), is_first, "left").withColumns({"is_nc": F.coalesce("is_nc", F.lit(False)), "date": F.to_date("created_at")})
    view.write("sales", daily.daily_sales(flagged), "date", again, of.unit)
    return view_days(view, "sales") if again is None else len(again)


def view_days(view: _View, part: str) -> int:
    return len(manifest(view.spark, f"{view.path}/{part}", view.now[part]).held)


def _refresh_part(view: _View, name: str, master: str, part: str, by: str, compute: Callable[[DataFrame], DataFrame]) -> int:
    """A part whose days are those of its master's rows."""
    days, of = view.changes(name, master)
    if days == []:
        return 0
    if of.by != by or part not in view.seen:
        days = None
    view.write(part, compute(read_master(view.spark, master, days, of.number)), "date", days, of.unit if of.by == by else "day")
    return view_days(view, part) if days is None else len(days)


def refresh_daily_view(spark: SparkSession, view: str, items: str, returns: str, ads: str, basis: str = "refund_date", exclude_cancelled: bool = False) -> dict[str, int]:
    """Bring the daily view at path view up to date with masters of items (by created_at), returns and ads; how many days of each part were computed.

    Which days changed is told by the masters' manifests: those stored elsewhere than in the versions that the view has seen.
    Of items, these days are read, as they were and as they are; orders that came or went touch their customers, of
    whom the view keeps the orders, in buckets, and the first order, by its day. Where a first order moved, the day that loses and the day that gains it are
    computed too. All is read by day or bucket, so the work follows the change and not the history. Returns (by the day of basis) and ads (by date_start)
    change nothing but their own days; stored by another column they are read whole. A view that has fallen behind
    more versions than a master keeps is made anew. A refresh that fails leaves the view as it was, since versions count
    only once all are written. The same parameters must be given each time.
    """
    at = _View(spark, view)
    day = {"refund_date": "order_completed_date", "conversion_date": "shopify_created_at"}
    if basis not in day:
        raise ValueError(f"unknown refund date basis: {basis}")
    done = {
        "sales": _refresh_sales(at, items, exclude_cancelled), "refunds": _refresh_part(at, "returns", returns, "refunds", day[basis], lambda df: daily.daily_refunds(df, basis)),
        "spend": _refresh_part(at, "ads", ads, "spend", "date_start", daily.daily_spend)}
    if at.now != _last(spark, view):
        at.commit()
    return done


def read_daily_view(spark: SparkSession, view: str) -> DataFrame:
    """daily_business as of the last refresh, from one row a day and part."""
    at = _View(spark, view)
    if not at.seen:
        raise FileNotFoundError(f"no view at {view}")
    return daily.margins(*[at.read(part) for part in _PARTS])
