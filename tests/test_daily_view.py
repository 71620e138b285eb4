"""The daily view kept up to date equals the table computed from all history."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from shopweave.operators import daily
from shopweave.plans import daily_view
from shopweave.plans.daily_view import read_daily_view, refresh_daily_view
from shopweave.sources import masters

M = "decimal(18,4)"
ITEMS = f"order_id int, item_id int, customer_id int, created_at timestamp, cancellation_status boolean, item_gross_revenue {M}, item_net_revenue {M}, total_cogs {M}, quantity {M}, total_shipping_cost {M}, total_packaging {M}, total_payment_fees {M}"
RETURNS = f"id int, status string, type string, order_completed_date timestamp, shopify_created_at timestamp, refund_amount {M}"
ADS = f"date_start date, ad_id int, spend {M}, impressions int, clicks int"
START = dt.datetime(2024, 1, 1)


def frame(spark, rows, schema):
    names = [x.split()[0] for x in schema.replace(M, "x").split(", ")]
    plain = schema.replace(M, "double")
    df = spark.createDataFrame(list(rows), plain)
    return df.select(*[F.col(n).cast(M).alias(n) if f"{n} {M}" in schema else F.col(n) for n in names])


def order(rng, k):
    at = None if rng.random() < 0.05 else START + dt.timedelta(days=rng.randrange(30), hours=rng.randrange(24))
    customer = rng.choice([None, None, 1, 1, 1, *range(2, 9)])
    return {(k, i): (k, i, customer, at, rng.choice([True, False, None]), *[float(rng.randrange(1, 99)) for _ in range(4)], 4.9, 1.0, 0.5) for i in range(rng.randrange(1, 4))}


def full(spark, items, returns, ads, cancelled, basis):
    df = daily.daily_business(frame(spark, items.values(), ITEMS), frame(spark, returns, RETURNS), frame(spark, ads, ADS), basis, cancelled)
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize(("cancelled", "basis", "unit"), [(False, "refund_date", "day"), (True, "conversion_date", "month")])
def test_view_equals_all_history_after_random_changes(spark, tmp_path, cancelled, basis, unit):
    rng = random.Random(cancelled)
    p = {n: str(tmp_path / n) for n in ("items", "returns", "ads", "view")}
    by = {"refund_date": "order_completed_date", "conversion_date": "shopify_created_at"}[basis]
    items = {}
    for k in range(40):
        items |= order(rng, k)
    day = lambda: START + dt.timedelta(days=rng.randrange(40))
    returns = [(k, rng.choice(["refunded", "open"]), rng.choice(["mix", "return", "exchange"]), rng.choice([None, day()]), day(), 5.5) for k in range(20)]
    ads = [(day().date(), k, 1.25, 3, 1) for k in range(20)]
    for turn in range(4):
        if turn % 3:
            for k in rng.sample(sorted({k for k, _ in items}), 5):  # orders go, change, or come again on another day
                items = {key: r for key, r in items.items() if key[0] != k}
                if rng.random() < 0.6:
                    items |= order(rng, k)
            items |= order(rng, 100 + turn)
        if turn == 2:
            returns, ads = returns[3:] + [(99, "refunded", "mix", day(), day(), 7.0)], ads[2:]
        if turn != 3:
            was = masters.manifest(spark, p["items"]).held
            df = frame(spark, items.values(), ITEMS)
            if was:  # only days that differ are written, as a refresh does
                old = masters.read_master(spark, p["items"])
                tag = lambda x: x.select(masters.day_of(x, "created_at", unit).alias("d"), F.xxhash64(*x.columns).alias("h")).groupBy("d").agg(F.sum(F.col("h").cast("decimal(38,0)")).alias("s"))
                days = [r["d"] for r in tag(df).unionByName(tag(old)).groupBy("d").agg(F.count_distinct("s").alias("c"), F.count("*").alias("n")).filter("c > 1 OR n < 2").collect()]
                masters.write_master(df.filter(masters.day_of(df, "created_at", unit).isin(days)), p["items"], "created_at", days, keep=3, unit=unit)
            else:
                masters.write_master(df, p["items"], "created_at", unit=unit)
        if turn in (0, 2):
            masters.write_master(frame(spark, returns, RETURNS), p["returns"], by)
            masters.write_master(frame(spark, ads, ADS), p["ads"], "date_start")
        done = refresh_daily_view(spark, p["view"], p["items"], p["returns"], p["ads"], basis, cancelled)
        assert [tuple(r) for r in read_daily_view(spark, p["view"]).collect()] == full(spark, items, returns, ads, cancelled, basis)
        if turn == 3:
            assert done == {"sales": 0, "refunds": 0, "spend": 0}
        if turn == 1:
            assert 0 < done["sales"] <= 31 and done["refunds"] == done["spend"] == 0


def small(spark, p, rows):
    masters.write_master(frame(spark, rows, ITEMS), p["items"], "created_at")


def test_only_changed_days_and_moved_first_orders_are_computed(spark, tmp_path):
    p = {n: str(tmp_path / n) for n in ("items", "returns", "ads", "view")}
    row = lambda k, customer, day: (k, 1, customer, START + dt.timedelta(day), False, 10.0, 8.0, 1.0, 1.0, 1.0, 1.0, 1.0)
    masters.write_master(frame(spark, [row(1, 1, 3), row(2, 1, 9), row(3, 2, 5), row(4, 3, 7)], ITEMS), p["items"], "created_at")
    masters.write_master(frame(spark, [], RETURNS), p["returns"], "order_completed_date")
    masters.write_master(frame(spark, [], ADS), p["ads"], "date_start")
    refresh = lambda: refresh_daily_view(spark, p["view"], p["items"], p["returns"], p["ads"])["sales"]
    new = lambda: {str(r["date"])[8:]: r["nc_gross_orders"] for r in read_daily_view(spark, p["view"]).collect()}
    assert refresh() == 4 and new() == {"04": 1, "10": 0, "06": 1, "08": 1}
    # the first order of customer 1 goes: its day and the day that gains the flag are computed, not the other two
    masters.write_master(frame(spark, [], ITEMS), p["items"], "created_at", ["2024-01-04"])
    assert refresh() == 2 and new() == {"10": 1, "06": 1, "08": 1}
    # an earlier order of customer 3 comes late
    masters.write_master(frame(spark, [row(5, 3, 1)], ITEMS), p["items"], "created_at", [])
    assert refresh() == 2 and new() == {"02": 1, "10": 1, "06": 1, "08": 0}
    # a refresh that dies before it commits changes nothing, and the next one does its work
    masters.write_master(frame(spark, [row(6, 2, 0)], ITEMS), p["items"], "created_at", [])
    monkey = daily_view._View.commit
    daily_view._View.commit = lambda self: 1 / 0
    try:
        with pytest.raises(ZeroDivisionError):
            refresh()
    finally:
        daily_view._View.commit = monkey
    assert new() == {"02": 1, "10": 1, "06": 1, "08": 0}
    assert refresh() == 2 and new() == {"01": 1, "02": 1, "10": 1, "06": 0, "08": 0}
    # a view that has fallen behind is made anew
    for k in range(7, 10):
        masters.write_master(frame(spark, [row(k, 4, k)], ITEMS), p["items"], "created_at", [], keep=2)
    assert refresh() == 6 and new()["08"] == 1
    with pytest.raises(FileNotFoundError):
        read_daily_view(spark, str(tmp_path / "no"))
