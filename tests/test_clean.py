import datetime as dt

import pytest
from pyspark.sql import functions as F

from shopweave.functions import features as X
from shopweave.operators import clean
from shopweave.plans import adapters as A
from shopweave.sources import landed


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return df.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(("name", "want"), [
    ("orderId", "order_id"), ("% paid", "percent_paid"), ("#1", "number_1"), ("2nd", "x2nd"), ("HTTPCode", "http_code"), ("Größe (cm)", "grosse_cm"), ("", "x"), ("a.b", "a_b"),
])
def test_clean_name(name, want):
    assert clean.clean_name(name) == want


def test_clean_names_repeats(spark):
    df = spark.range(1).select(F.lit(1).alias("a b"), F.lit(2).alias("a.b"), F.lit(3).alias("aB"))
    assert clean.clean_names(df).columns == ["a_b", "a_b_2", "a_b_3"]


@pytest.mark.parametrize(("text", "want"), [
    ("2024-01-02t03:04:05z", dt.datetime(2024, 1, 2, 3, 4, 5)), ("2024-01-02T03:04:05+0100", dt.datetime(2024, 1, 2, 2, 4, 5)), ("2024-01-02 03:04:05", dt.datetime(2024, 1, 2, 3, 4, 5)),
    ("2024-01-02t03:04:05.5+01:00", dt.datetime(2024, 1, 2, 2, 4, 5, 500000)), (" ", None), ("bald", None), (None, None),
])
def test_parse_utc(spark, text, want):
    got = one(spark, X.parse_utc(F.col("t").cast("string")), t=text)
    assert (got and got.replace(tzinfo=None)) == want


def test_normalize_trims_any_blank_and_leaves_arrays(spark):
    df = spark.createDataFrame([("\t  Ab 　", ["X "])], "a string, b array<string>")
    assert tuple(clean.normalize_strings(df).first()) == ("ab", ["X "])


@pytest.mark.parametrize(("text", "want"), [
    ("#12345678", "12345678"), ("x 12345678 y", "12345678"), ("#123456789", "12345678"), ("12000000 siehe #12345678", "12345678"), ("#12000000 oder 12345678", None),
    ("123456789", None), ("nichts", None), (None, None),
])
def test_order_number(spark, text, want):
    assert one(spark, X.extract_order_number(F.col("t").cast("string"), F.lit(None).cast("string")), t=text) == want


def test_map_ids(spark):
    names = X.lookup(A.agents(spark))
    at = lambda v, mode: one(spark, X.map_ids(F.col("v").cast("string"), names, mode), v=v)
    assert at("10000000000015", "prefix") == "agent_a"
    assert at("10000000000015", "exact") == "10000000000015"
    assert at("1000000000001", "exact") == "agent_a"
    assert at(None, "prefix") is None
    with pytest.raises(ValueError, match="unknown mode"):
        X.map_ids(F.col("v"), names, "near")
    with pytest.raises(ValueError, match="more than"):
        X.lookup(spark.range(2000).select("id", F.lit("n").alias("name")))


def test_id_arrays(spark):
    names = X.lookup(A.agents(spark))
    df = spark.createDataFrame([(None,), ([],), ([None],), ([1000000000001, 5],)], "a array<bigint>")
    assert [r[0] for r in df.select(X.map_id_array(F.col("a"), names, "prefix")).collect()] == [[None], [None], [None], ["agent_a", "5"]]


def test_payment_rules(spark):
    texts = ["paypal wallet x", "in 30 tagen", "3 rate", "pay in 4", "ratenzahlung", "karte", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(X.classify(F.col("t"), X.PAYMENT_RULES, F.col("t")))
    assert [r[0] for r in df.collect()] == ["paypal wallet", "rechnung (30 tage)", "ratenzahlung (3 raten)", "ratenzahlung (4 raten)", "ratenzahlung (allgemein)", "karte", None]


def test_order_features_of_nothing(spark):
    df = spark.createDataFrame([(None, None, None), ([], [], []), (["A", None], [("x",)], [(None,)])], "g array<string>, d array<struct<code:string>>, r array<struct<created_at:string>>")
    got = df.select(X.payment_method(F.col("g")), X.discount_code(F.col("d")), X.first_refund(F.col("r"))).collect()
    assert [tuple(r) for r in got] == [("", None, None), ("", None, None), ("A, NA", "x", None)]


def test_orders_without_lines_go_and_text_in_arrays_keeps_case(spark, sf_dir):
    raw = A.raw_orders(spark, sf_dir)
    got = clean.clean_orders(raw)
    assert got.select("order_id").distinct().count() == raw.filter(F.size("line_items") > 0).count()
    assert got.filter("product_sku LIKE 'sku%'").count() == 0
    assert len(got.columns) == 32
    assert clean.clean_shop(raw.limit(0), "orders").count() == 0
    with pytest.raises(ValueError, match="unknown shop endpoint"):
        clean.clean_shop(raw, "carts")


def test_products_are_lower_cased_in_variants(spark, sf_dir):
    got = clean.clean_products(A.raw_products(spark, sf_dir))
    assert got.filter("variants_title LIKE 'G%'").count() == 0
    assert not {"published_scope", "image_src", "tags", "variants_weight_unit"} & set(got.columns)


def test_personal_columns_go(spark):
    df = spark.createDataFrame([(1, "a", "b", "c")], "id int, email string, default_address_zip string, total_spent string")
    assert clean.drop_personal(df, "customers").columns == ["id", "total_spent"]
    with pytest.raises(ValueError, match="unknown source"):
        clean.drop_personal(df, "others")


def test_prune(spark):
    df = spark.range(1).select(F.lit(1).alias("a"), F.lit(1).alias("b"), F.lit(1).alias("ba"))
    assert clean.prune_columns(df, prefixes=("b",)).columns == ["a"]
    assert clean.prune_columns(df, optional=("z", "a")).columns == ["b", "ba"]
    with pytest.raises(ValueError, match="missing columns: z"):
        clean.prune_columns(df, strict=("z",))


def test_reviews_refuse_nothing(spark, sf_dir):
    with pytest.raises(ValueError, match="no reviews"):
        clean.clean_reviews(A.raw_reviews(spark, sf_dir).limit(0), check_empty=True)


def test_tickets_merge_equal_rows_and_widen(spark, sf_dir):
    raw = A.raw_tickets(spark, sf_dir)
    twice = clean.clean_tickets(raw.unionByName(raw), A.agents(spark), A.groups(spark))
    once = clean.clean_tickets(raw, A.agents(spark), A.groups(spark), followers=2)
    assert twice.count() == once.count()
    assert {"follower_ids_1", "follower_ids_2"} <= set(once.columns)


def test_daily_ads_fill_zero_after_distinct(spark, sf_dir):
    raw = A.raw_ads(spark, sf_dir)
    got = clean.clean_ad_insights(raw, "daily")
    assert got.filter("spend IS NULL OR impressions IS NULL OR clicks IS NULL").count() == 0
    assert got.columns[-1] == "date_stop"
    with pytest.raises(ValueError, match="granularity"):
        clean.clean_ad_insights(raw, "weekly")


def test_missing_spend_equals_a_spend_of_zero(spark, sf_dir):
    given = A.raw_ads(spark, sf_dir).limit(1).withColumns({"spend": F.lit("0.0000"), "clicks": F.lit("0")})
    raw = given.unionByName(given.withColumn("spend", F.lit("n/a"))).unionByName(given.withColumn("clicks", F.lit(None).cast("string")))
    for granularity in ("daily", "hourly"):
        got = clean.clean_ad_insights(raw, granularity).collect()
        assert [(r["spend"], r["clicks"]) for r in got] == [(0, 0)]


def test_landed_pages(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"data": {"data": [{"id": 1, "m": {"v": "x"}}, {"id": 2}]}}')
    (tmp_path / "b.json").write_text('{\n "data": {"data": []}}')
    (tmp_path / "c.json").write_text('{"other": 1}')
    got = landed.read_landed_pages(spark, str(tmp_path), "data.data", "data struct<data: array<struct<id int, m struct<v string>>>>")
    assert sorted(tuple(r) for r in got.collect()) == [(1, "x"), (2, None)]
    assert got.columns == ["id", "m_v"]


def test_read_clean_refuses_unknown(spark):
    with pytest.raises(ValueError, match="unknown file kind"):
        landed.read_clean(spark, "x", "xlsx")


def test_widen_by_longest(spark):
    df = spark.createDataFrame([(1, ["a"]), (2, ["a", "b"]), (3, None)], "id int, f array<string>")
    got = X.widen_array(df, "f")
    assert got.columns == ["id", "f_1", "f_2"]
    assert [tuple(r) for r in got.orderBy("id").collect()] == [(1, "a", None), (2, "a", "b"), (3, None, None)]
