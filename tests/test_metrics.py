import datetime as dt
import math
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shopweave.operators import daily, draw, market, support, themes, upsert
from shopweave.plans import adapters as A
from shopweave.plans.refresh import refresh_source
from shopweave.sources import landed, masters
from shopweave.streaming.upserts import stream_upserts

ITEM = "order_id bigint, customer_id bigint, created_at timestamp, cancellation_status boolean, item_gross_revenue double, item_net_revenue double, total_cogs double, total_shipping_cost double, total_packaging double, total_payment_fees double, quantity double"


def day(d, h=0):
    return dt.datetime(2024, 1, d, h)


def items(spark, rows):
    return spark.createDataFrame(rows, ITEM)


def test_first_order_ties_and_guests(spark):
    df = items(spark, [
        (2, 7, day(1), False, *[1.0] * 7), (1, 7, day(1), False, *[1.0] * 7), (3, 7, None, False, *[1.0] * 7), (4, None, day(2), False, *[1.0] * 7), (5, None, day(3), False, *[1.0] * 7),
    ])
    got = {r["order_id"]: r["is_nc"] for r in daily.new_customer_flag(df).collect()}
    assert got == {1: True, 2: False, 3: False, 4: True, 5: False}


def test_cancelled_orders_count_unless_excluded(spark):
    df = items(spark, [(1, 1, day(1), True, *[2.0] * 7), (2, 2, day(1), None, *[3.0] * 7)])
    assert daily.daily_items(df).first()["gross_revenue"] == 5
    assert daily.daily_items(df, exclude_cancelled=True).first()["gross_revenue"] == 3


def test_order_costs_count_once_but_twice_if_they_differ(spark):
    row = (1, 1, day(1), False, 10.0, 8.0, 4.0, 5.0, 1.0, 0.5, 1.0)
    got = daily.daily_orders(items(spark, [row, row])).first()
    assert (got["fulfillment_costs"], got["gross_orders"], got["nc_gross_orders"]) == (6, 1, 1)
    got = daily.daily_orders(items(spark, [row, (*row[:9], 0.7, 1.0)])).first()
    assert (got["fulfillment_costs"], got["gross_orders"], got["nc_gross_orders"]) == (12, 1, 2)


def test_unknown_order_id_is_an_order(spark):
    got = daily.daily_orders(items(spark, [(None, 1, day(1), False, *[1.0] * 7), (2, 2, day(1), False, *[1.0] * 7)])).first()
    assert got["gross_orders"] == 2


def test_repeated_items_leave_order_costs_alone(spark, sf_dir):
    df = A.financial_items(spark, sf_dir)
    once, twice = ({r["date"]: r for r in daily.daily_orders(x).collect()} for x in (df, df.unionByName(df)))
    assert once == twice


def test_cascade_adds_up(spark, sf_dir):
    for r in daily.daily_business(A.financial_items(spark, sf_dir), A.returns_clean(spark, sf_dir), A.ads_daily(spark, sf_dir), "conversion_date").collect():
        spent = r["channel_spend"] + r["fulfillment_costs"] + r["transaction_costs"] + r["product_costs"] + r["refunds"] + r["taxes"]
        assert math.isclose(r["cm3"] + spent, r["gross_revenue"], abs_tol=1e-6)


def test_refund_rules(spark):
    df = spark.createDataFrame(
        [("refunded", "return", day(1), day(2), 5.0), ("refunded", "exchange", day(1), day(2), 5.0), ("open", "mix", day(1), day(2), 5.0), ("refunded", "mix", None, day(2), 7.0), ("refunded", "mix", day(3), None, None)],
        "status string, type string, order_completed_date timestamp, shopify_created_at timestamp, refund_amount double")
    assert {r["date"].day: r["refunds"] for r in daily.daily_refunds(df).collect()} == {1: 5, 3: 0}
    assert {r["date"].day: r["refunds"] for r in daily.daily_refunds(df, "conversion_date").collect()} == {2: 12}
    with pytest.raises(ValueError, match="basis"):
        daily.daily_refunds(df, "x")


def test_business_of_disjoint_days_and_nothing(spark, sf_dir):
    none = A.financial_items(spark, sf_dir).limit(0)
    ads = A.ads_daily(spark, sf_dir)
    got = daily.daily_business(none, A.returns_clean(spark, sf_dir).limit(0), ads).collect()
    assert len(got) == ads.select("date_start").distinct().count()
    assert all(r["cm3"] == -r["channel_spend"] and r["gross_orders"] == 0 for r in got)


def weeks(spark, closes, volumes=None):
    start = dt.date(2024, 1, 1)
    rows = [(start + dt.timedelta(7 * i), float(closes[max(i - 1, 0)]), float(c), float(c), float(c), float((volumes or [1] * len(closes))[i])) for i, c in enumerate(closes)]
    return spark.createDataFrame(rows, "week_start date, open double, high double, low double, close double, volume double")


def test_colors(spark):
    got = [r["fill_color"] for r in market.volume_spread_color(weeks(spark, [1, 2, 3, 4, 5, 1, 2, 1], [1, 1, 1, 1, 9, 1, 20, 1])).orderBy("week_start").collect()]
    assert got == ["yellow"] * 4 + ["green", "red", "green", "red"]
    assert market.volume_spread_color(weeks(spark, [2, 1])).orderBy("week_start").collect()[1]["fill_color"] == "grey"


def test_rsi_waits_for_14_changes_and_survives_no_loss(spark):
    got = market.rsi(weeks(spark, list(range(16)))).orderBy("week_start").collect()
    assert [r["rsi"] is None for r in got] == [True] * 14 + [False] * 2
    assert got[-1]["rsi"] == pytest.approx(100)
    assert all(r["rsi"] is None for r in market.rsi(weeks(spark, [1, 2, 3])).collect())


def test_crossovers_are_never_null(spark):
    got = market.sma_crossovers(weeks(spark, [10] * 12 + [1, 1, 1, 30, 30, 30])).orderBy("week_start").collect()
    assert all(r["is_crossover"] is not None for r in got)
    assert any(r["cross_up"] for r in got)


def test_week_opens_at_last_close_and_drops_returned_orders(spark):
    rows = [(1, "paid", day(1), 5.0, 1.0), (2, "paid", day(2), 7.0, 1.0), (3, "paid", day(9), 4.0, 2.0), (4, "pending", day(9), 9.0, 1.0), (5, "paid", day(10), 9.0, 1.0)]
    df = spark.createDataFrame(rows, "order_id bigint, financial_status string, created_at timestamp, item_gross_revenue double, quantity double")
    back = spark.createDataFrame([(5, "return"), (3, "mix")], "shopify_order_id bigint, type string")
    got = [tuple(r)[1:] for r in market.weekly_ohlc(df, back).orderBy("week_start").collect()]
    assert got == [(5, 7, 5, 7, 2), (7, 4, 4, 4, 2)]


def test_label(spark, sf_dir):
    assert market.weekly_market_view(A.financial_items(spark, sf_dir), A.returns_clean(spark, sf_dir)).first()["hover_text"].startswith("<b>Woche: ")


def test_themes_keep_capitals_and_skip_missing(spark):
    df = spark.createDataFrame([("1", "de", 1, "Die Sohle", "drückt Sohle"), ("2", "de", 5, "Farbe", "toll"), ("3", "de", None, "Weg", "x"), ("4", "en", 1, "Size", "x"), ("5", "de", 2, None, "Fehlt")],
                               "id string, language string, stars int, title string, text string")
    got = {(r["rating_group"], r["word"]): r["n"] for r in themes.noun_themes(df).collect()}
    assert got == {("Kritisch (1-3)", "sohle"): 2, ("Kritisch (1-3)", "die"): 1, ("Positiv (4-5)", "farbe"): 1}


def test_tagger_can_be_replaced(spark):
    df = spark.createDataFrame([("1", "de", 1, "a", "b")], "id string, language string, stars int, title string, text string")
    got = themes.noun_themes(df, tagger=lambda t: t.select("doc_id", F.lit("W").alias("word"), F.lit("PROPN").alias("upos"), F.lit("Wort").alias("lemma"))).collect()
    assert [(r["word"], r["n"]) for r in got] == [("wort", 1)]


def test_draw(spark):
    df = spark.range(200).select(F.col("id").cast("string").alias("id"), F.when(F.col("id") < 100, 0).otherwise(F.col("id") % 3).cast("long").alias("amount_lose"))
    prizes = [("a", 3), ("b", 7)]
    got = draw.weighted_draw(df, prizes=prizes).collect()
    assert got == draw.weighted_draw(df.repartition(7), prizes=prizes).collect() or sorted(got) == sorted(draw.weighted_draw(df.repartition(7), prizes=prizes).collect())
    assert sorted(r["prize"] for r in got) == ["a"] * 3 + ["b"] * 7
    assert all(r["amount_lose"] > 0 for r in got) and len({r["id"] for r in got}) == 10
    with pytest.raises(ValueError, match="fewer than"):
        draw.weighted_draw(df, prizes=[("a", 150)])


def test_draw_follows_weights(spark):
    df = spark.range(20).select(F.col("id").cast("string").alias("id"), F.when(F.col("id") == 0, 20).otherwise(1).alias("amount_lose"))
    wins = sum(draw.weighted_draw(df, prizes=[("a", 1)], seed=str(s)).first()["id"] == "0" for s in range(40))
    assert 10 <= wins <= 31  # expected 20.5


def test_duplicates_with_null_keys(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x"), (3, None)], "a int, b string")
    assert sorted(tuple(r) for r in support.find_duplicates(df, ["a", "b"]).collect()) == [(1, None), (1, None)]


def test_box_has_outliers(spark):
    df = spark.createDataFrame([(i, "a", "open", float(x)) for i, x in enumerate([1, 2, 3, 4, 100])] + [(9, None, "new", 1.0)], "id int, assignee_id string, status string, ticket_duration_min double")
    r = support.duration_box_stats(df).collect()
    assert [tuple(x) for x in r] == [("a", "open", 5, 1.0, 2.0, 3.0, 4.0, 4.0, 1)]


def test_boxes_equal_brute_force_with_hot_agents_and_nulls(spark):
    import random
    import statistics

    rng = random.Random(2)
    rows = [(i, rng.choice(["hot", "hot", "hot", "b", None]), rng.choice(["open", None]), rng.choice([None, 5.0, 5.0, rng.random() * 100])) for i in range(900)]
    rows += [(2000 + i, "silent", "open", None) for i in range(3)] + [(3000, "one", "open", 7.0), (3001, None, "new", 1.0)]
    df = spark.createDataFrame(rows, "id int, assignee_id string, status string, ticket_duration_min double").repartition(9)
    want = {}
    for key in {(a, s) for _, a, s, _ in rows if a is not None or s not in (None, "new")}:
        xs = sorted(x for _, a, s, x in rows if (a, s) == key and x is not None)
        q = statistics.quantiles(xs, n=4, method="inclusive") if len(xs) > 1 else xs * 3 or [None] * 3
        inside = [x for x in xs if q[0] - 1.5 * (q[2] - q[0]) <= x <= q[2] + 1.5 * (q[2] - q[0])]
        want[key] = (len(xs), min(inside, default=None), *q, max(inside, default=None), len(xs) - len(inside))
    got = {(r[0], r[1]): tuple(r)[2:] for r in support.duration_box_stats(df).collect()}
    near = lambda v: tuple(round(x, 9) if isinstance(x, float) else x for x in v)
    assert {k: near(v) for k, v in got.items()} == {k: near(v) for k, v in want.items()}
    plan = support.duration_box_stats(df)._jdf.queryExecution().optimizedPlan().toString()
    # the one window goes over counts of partitions, never over values
    assert "Window [sum(rows" in plan and plan.count("Window [") <= 2 and "x#" not in plan[plan.index("Window [") :].split("\n")[0]


def test_places_deal_ties_and_groups(spark):
    from shopweave.operators.places import placed

    df = spark.range(0, 1000, 1, 7).selectExpr("CASE WHEN id < 990 THEN 'hot' END AS g", "CASE WHEN id % 3 > 0 THEN 5 ELSE id END AS x", "1 AS place")
    got = placed(df, ["g"], "x").collect()
    for g, n in (("hot", 990), (None, 10)):
        mine = sorted((r["place"], r["x"]) for r in got if r["g"] == g)
        assert [p for p, _ in mine] == list(range(n)) and [x for _, x in mine] == sorted(x for _, x in mine)
    assert {r["n"] for r in got} == {990, 10} and placed(df.limit(0), ["g"], "x").count() == 0


ROW = "k int, at timestamp, v string"


def test_upsert_order_and_idempotence(spark):
    old = spark.createDataFrame([(1, day(9), "old"), (2, day(1), "kept")], ROW)
    new = spark.createDataFrame([(1, day(1), "a"), (1, day(2), "b"), (3, None, "n"), (3, day(1), "m")], ROW)
    once = upsert.upsert_latest(new, old, ["k"], "at")
    assert sorted((r["k"], r["v"]) for r in once.collect()) == [(1, "b"), (2, "kept"), (3, "m")]
    assert sorted(upsert.upsert_latest(new, once, ["k"], "at").collect()) == sorted(once.collect())


def test_upsert_without_key_and_with_other_columns(spark):
    old = spark.createDataFrame([(1, "x")], "k int, v string")
    new = spark.createDataFrame([(1, "x", 5), (2, "y", 6)], "k int, v string, extra int")
    assert upsert.upsert_latest(new, old, []).count() == 3
    assert sorted(tuple(r) for r in upsert.upsert_latest(new, old, ["k"]).collect()) == [(1, "x", 5), (2, "y", 6)]
    assert upsert.upsert_latest(old, old, ["nope"]).count() == 1


def test_append_is_strict(spark):
    old = spark.createDataFrame([(1, day(2), "x")], ROW)
    new = spark.createDataFrame([(1, day(2), "edited"), (2, day(3), "y")], ROW)
    assert sorted(r["v"] for r in upsert.append_newer(new, old, "at").collect()) == ["x", "y"]
    assert upsert.append_newer(new, old.limit(0), "at").count() == 2


def test_replace_window(spark):
    d = lambda n: dt.date(2024, 1, n)
    schema = "date date, hour string, ad_id string"
    old = spark.createDataFrame([(d(1), "0", "a"), (d(5), "9", "a"), (d(9), "1", "a")], schema)
    new = spark.createDataFrame([(d(5), "10", "b"), (d(5), "9", "b"), (d(5), "9", "b")], schema)
    got = [tuple(r) for r in upsert.in_order(upsert.replace_window(old, new, "date", d(4)), "date").collect()]
    assert got == [(d(1), "0", "a"), (d(5), "9", "b"), (d(5), "10", "b")]
    assert upsert.replace_window(old, new, "date", d(4), d(8)).count() == 4
    assert upsert.replace_window(old, new.limit(0), "date", d(1)).count() == 3
    again = upsert.replace_window(upsert.replace_window(old, new, "date", d(4)), new, "date", d(4))
    assert sorted(map(tuple, again.collect()), key=str) == sorted(got, key=str)


def test_next_window(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 10),)], "d date")
    w = upsert.next_window(df, "d", dt.date(2024, 1, 20)).first()
    assert (w["start_date"], w["due"]) == (dt.date(2024, 1, 8), True)
    assert upsert.next_window(df, "other", dt.date(2024, 1, 20)).first()["start_date"] == dt.date(2024, 1, 13)
    assert not upsert.next_window(df, "d", dt.date(2024, 1, 1)).first()["due"]
    assert upsert.next_window(df.limit(0), "d", dt.date(2024, 1, 20)).first()["start_date"] == dt.date(2024, 1, 13)


@pytest.mark.parametrize("how", ["upsert", "append", "replace"])
def test_refresh_counts(spark, tmp_path, how):
    path = str(tmp_path / "m")
    old = spark.createDataFrame([(1, day(1), "o"), (2, day(8), "o")], ROW)
    masters.write_master(old, path)
    new = spark.createDataFrame([(2, day(8), "n"), (3, day(9), "n"), (4, day(1), "too old")], ROW)
    got = refresh_source(spark, path, new, lambda df: df, how, "at", dt.date(2024, 1, 10), ["k"])
    assert got == {"new": 2, "total": 3}
    stored = {r["k"]: r["v"] for r in masters.read_master(spark, path).collect()}
    assert stored == {1: "o", 2: "o" if how == "append" else "n", 3: "n"}


@pytest.mark.parametrize("how", ["upsert", "append", "replace"])
def test_refresh_by_day_reads_and_writes_only_days_that_change(spark, tmp_path, how):
    path = str(tmp_path / "m")
    old = spark.createDataFrame([(1, day(1), "o"), (2, day(8), "o"), (5, day(2), "moves"), (6, None, "no day")], ROW)
    masters.write_master(old, path, "at", keys=[] if how == "replace" else ["k"])
    new = spark.createDataFrame([(2, day(8), "n"), (3, day(9), "n"), (5, day(9), "moved"), (4, day(1), "too old")], ROW)
    got = refresh_source(spark, path, new, lambda df: df, how, "at", dt.date(2024, 1, 10), ["k"], by="at")
    stored = sorted((r["k"], r["v"]) for r in masters.read_master(spark, path).collect())
    if how == "replace":
        assert stored == [(1, "o"), (2, "n"), (3, "n"), (5, "moved"), (5, "moves"), (6, "no day")]
    else:
        assert stored == [(1, "o"), (2, "o" if how == "append" else "n"), (3, "n"), (5, "moved"), (6, "no day")]
    assert got == {"new": 3, "total": len(stored)}
    plan = masters.read_master(spark, path, ["2024-01-09"])._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in plan and "2024-01-09" in plan and masters.read_master(spark, path, ["2024-01-09"]).count() == 2
    of = masters.manifest(spark, path)
    assert of.number == 2 and of.held["2024-01-01"].startswith("v1") and of.held["2024-01-09"].startswith("v2")


def test_masters_of_nothing_and_failed_writers(spark, tmp_path):
    path, empty = str(tmp_path / "m"), spark.createDataFrame([], ROW)
    masters.write_master(empty, path, "at")
    assert masters.read_master(spark, path).count() == 0 and masters.read_master(spark, path).columns == empty.columns
    empty.write.parquet(f"{path}/data/__version=v2-left/__day=none")  # a writer that died before its manifest
    masters.write_master(spark.createDataFrame([(1, day(1), "x")], ROW), path, "at", [])
    assert [r["v"] for r in masters.read_master(spark, path).collect()] == ["x"]
    with pytest.raises(ValueError, match="unknown way"):
        refresh_source(spark, path, empty, lambda df: 1 / 0, "merge", "at", dt.date(2024, 1, 1))


def test_order_dates_must_agree(spark):
    df = spark.createDataFrame([(1, day(1)), (1, day(1)), (2, day(1)), (2, day(3)), (3, None), (3, day(2)), (None, day(4))], "order_id int, created_at timestamp")
    assert sorted(map(tuple, daily.order_date_violations(df).collect())) == [(2, day(1), day(3), 2), (3, day(2), day(2), 2)]


def test_stream_merges_batches_once(spark, tmp_path):
    path, inbox = str(tmp_path / "m"), str(tmp_path / "in")
    masters.write_master(spark.createDataFrame([(1, day(1), "o")], ROW), path)
    for batch in ([(1, day(2), "n"), (2, day(2), "n")], [(2, day(3), "later")]):
        spark.createDataFrame(batch, ROW).write.mode("append").parquet(inbox)
        stream_upserts(spark, inbox, ROW, path, str(tmp_path / "c"), ["k"], updated="at").awaitTermination()
    assert sorted((r["k"], r["v"]) for r in masters.read_master(spark, path).collect()) == [(1, "n"), (2, "later")]


def test_money_is_exact(spark):
    df = items(spark, [(i, i, day(1), False, 0.1, 0.1, 0.1, 0.0, 0.0, 0.0, 1.0) for i in range(1000)])
    assert Decimal(str(daily.daily_items(df).first()["gross_revenue"])) == Decimal("100.0")
