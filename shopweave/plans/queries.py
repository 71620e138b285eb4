"""The registered queries of the shop operators and the SQL that checks them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopweave.functions import features as X
from shopweave.operators import clean, daily, draw, market, prefixes, support, tagger, themes, upsert
from shopweave.plans import adapters as A
from shopweave.plans.daily_view import read_daily_view, refresh_daily_view
from shopweave.plans.refresh import merge_into, refresh_source, upsert_into
from shopweave.session import new_path
from shopweave.sources import landed, ledger, masters
from shopweave.streaming.upserts import stream_upserts

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

_M = "DECIMAL(18,4)"
ITEMS = f"""items AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS created_at, o_orderstatus = 'P' AS cancellation_status,
    CASE o_orderstatus WHEN 'F' THEN 'paid' WHEN 'O' THEN 'partially_paid' ELSE 'pending' END AS financial_status, l_linenumber AS item_id,
    ((l_extendedprice::{_M} * (1 - l_discount::{_M}))::{_M} * (1 + l_tax::{_M}))::{_M} AS item_gross_revenue,
    (l_extendedprice::{_M} * (1 - l_discount::{_M}))::{_M} AS item_net_revenue, (l_extendedprice::{_M} * 0.40)::{_M} AS total_cogs, 4.90::{_M} AS total_shipping_cost,
    (CASE WHEN o_orderpriority = '1-URGENT' THEN 1.50 ELSE 0.80 END)::{_M} AS total_packaging, (o_totalprice::{_M} * 0.02)::{_M} AS total_payment_fees,
    l_quantity::{_M} AS quantity, l_shipdate AS shipped_at, l_partkey AS part_id
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey)"""
RETURNS = f"""returns AS (
  SELECT o_orderkey AS shopify_order_id, CASE l_linestatus WHEN 'F' THEN 'refunded' ELSE 'open' END AS status, ['return', 'mix', 'exchange'][l_linenumber % 3 + 1] AS type,
    l_shipdate AS order_completed_date, o_orderdate AS shopify_created_at, (l_extendedprice::{_M} * (1 - l_discount::{_M}))::{_M} AS refund_amount
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE l_returnflag = 'R')"""
ADS = f"""ads AS (
  SELECT ts::DATE - 9131 AS date_start, event_id::VARCHAR AS ad_id, value::{_M} AS spend, 1 AS impressions, (event_type = 'click')::INT AS clicks FROM events)"""
FLAGS = """flags AS (
  SELECT order_id, customer_id, created_at, row_number() OVER (PARTITION BY customer_id ORDER BY created_at NULLS LAST, order_id) = 1 AS is_nc
  FROM (SELECT DISTINCT order_id, customer_id, created_at FROM items)),
flagged AS (SELECT items.*, created_at::DATE AS date, is_nc FROM items JOIN flags USING (order_id, customer_id, created_at))"""
D_ITEMS = f"""d_items AS (
  SELECT date, sum(item_gross_revenue)::DOUBLE AS gross_revenue, sum(item_net_revenue)::DOUBLE AS net_revenue_items, sum(total_cogs)::DOUBLE AS product_costs, sum(quantity)::DOUBLE AS gross_quantity,
    coalesce(sum(item_gross_revenue) FILTER (is_nc), 0)::DOUBLE AS nc_gross_revenue, (sum(item_gross_revenue) - sum(item_net_revenue))::DOUBLE AS taxes FROM flagged GROUP BY date)"""
D_ORDERS = """d_orders AS (
  SELECT date, (sum(total_shipping_cost) + sum(total_packaging))::DOUBLE AS fulfillment_costs, sum(total_payment_fees)::DOUBLE AS transaction_costs,
    count(DISTINCT order_id)::BIGINT AS gross_orders, sum(is_nc::INT)::BIGINT AS nc_gross_orders
  FROM (SELECT DISTINCT order_id, date, is_nc, total_shipping_cost, total_packaging, total_payment_fees FROM flagged) GROUP BY date)"""
D_REFUNDS = """d_refunds AS (
  SELECT order_completed_date::DATE AS date, sum(refund_amount)::DOUBLE AS refunds FROM returns WHERE status = 'refunded' AND type IN ('return', 'mix') GROUP BY ALL)"""
D_SPEND = """d_spend AS (
  SELECT date_start AS date, sum(spend)::DOUBLE AS channel_spend, sum(impressions)::BIGINT AS channel_impressions, sum(clicks)::BIGINT AS channel_clicks FROM ads GROUP BY ALL)"""
WEEKLY = f"""sold AS (SELECT * FROM items WHERE financial_status IN ('paid', 'partially_paid') AND order_id NOT IN (SELECT shopify_order_id FROM returns WHERE type = 'return')),
days AS (SELECT created_at::DATE AS date, sum(item_gross_revenue) AS revenue, sum(quantity) AS quantity FROM sold GROUP BY ALL),
weeks AS (SELECT date_trunc('week', date)::DATE AS week_start, max(revenue) AS high, min(revenue) AS low, max_by(revenue, date) AS close, sum(quantity) AS volume FROM days GROUP BY ALL),
ohlc AS (SELECT week_start, coalesce(lag(close) OVER w, first(low) OVER w) AS open, high, low, close, volume FROM weeks WINDOW w AS (ORDER BY week_start)),
signs AS (SELECT *, close >= open AS bullish, CASE WHEN count(*) OVER w4 = 4 THEN sum(volume) OVER w4 END AS v4, CASE WHEN count(*) OVER w4 = 4 THEN sum(close) OVER w4 END AS s4,
    CASE WHEN count(*) OVER w12 = 12 THEN sum(close) OVER w12 END AS s12, close - lag(close) OVER (ORDER BY week_start) AS change
  FROM ohlc WINDOW w4 AS (ORDER BY week_start ROWS 3 PRECEDING), w12 AS (ORDER BY week_start ROWS 11 PRECEDING)),
gains AS (SELECT *, CASE WHEN change IS NOT NULL THEN greatest(change, 0) END AS gain, CASE WHEN change IS NOT NULL THEN greatest(-change, 0) END AS loss,
    lag(3 * s4) OVER (ORDER BY week_start) AS f0, lag(s12) OVER (ORDER BY week_start) AS l0, 3 * s4 AS f1, s12 AS l1 FROM signs),
means AS (SELECT *, CASE WHEN count(gain) OVER w = 14 THEN (sum(gain) OVER w)::DOUBLE / 14 END AS avg_gain, CASE WHEN count(loss) OVER w = 14 THEN (sum(loss) OVER w)::DOUBLE / 14 END AS avg_loss
  FROM gains WINDOW w AS (ORDER BY week_start ROWS 13 PRECEDING)),
crossed AS (SELECT *, f0 < l0 AND f1 >= l1 AS cross_up, f0 > l0 AND f1 <= l1 AS cross_dn, avg_gain / CASE WHEN avg_loss = 0 THEN 1e-10 ELSE avg_loss END AS rs FROM means),
v AS (SELECT week_start, open::DOUBLE AS open, high::DOUBLE AS high, low::DOUBLE AS low, close::DOUBLE AS close, volume::DOUBLE AS volume, bullish, v4::DOUBLE / 4 AS vol_sma4,
    CASE WHEN bullish AND 4 * volume >= 2 * v4 THEN 'green' WHEN bullish AND 8 * volume >= 3 * v4 THEN 'turquoise' WHEN bullish THEN 'yellow'
      WHEN 8 * volume <= v4 THEN 'red' WHEN 16 * volume <= 3 * v4 THEN 'pink' ELSE 'grey' END AS fill_color,
    s4::DOUBLE / 4 AS sma_fast, s12::DOUBLE / 12 AS sma_slow, cross_up, cross_dn, coalesce(cross_up IS NOT NULL AND cross_dn IS NOT NULL AND (cross_up OR cross_dn), false) AS is_crossover,
    change::DOUBLE AS change, gain::DOUBLE AS gain, loss::DOUBLE AS loss, avg_gain, avg_loss, rs, 100 - 100 / (1 + rs) AS rsi,
    printf('<b>Woche: %s</b><br>Open: %.2f €<br>High: %.2f €<br>Low: %.2f €<br>Close: %.2f €<br>Volumen: %d Stück', strftime(week_start, '%d.%m.%Y'),
      round(open, 2)::DOUBLE, round(high, 2)::DOUBLE, round(low, 2)::DOUBLE, round(close, 2)::DOUBLE, volume::BIGINT) AS hover_text FROM crossed)"""
TICKETS = """turns AS (
  SELECT conv_id AS id, make_timestamp((1704067200 + conv_id * 60) * 1000000) AS created_at, make_timestamp((1704067200 + conv_id * 60 + turn * 90) * 1000000) AS updated_at,
    'frage zu ' || ['#', '', '12000000 siehe #', '#12000000 oder '][conv_id % 4 + 1] || (12100000 + conv_id) AS description,
    CASE role WHEN 'user' THEN 'open' WHEN 'assistant' THEN 'closed' ELSE 'new' END AS status, lower(role) AS via_channel,
    CASE conv_id % 3 WHEN 0 THEN 'agent_a' WHEN 1 THEN '1000000000003' END AS assignee_id,
    CASE conv_id % 4 WHEN 3 THEN NULL ELSE (12100000 + conv_id)::VARCHAR END AS bestellnummer,
    unnest(CASE conv_id % 2 WHEN 0 THEN ['agent_a', '1000000000009'] ELSE [NULL] END) AS collaborator_id,
    CASE conv_id % 3 WHEN 0 THEN ['agent_a', '1000000000009'] ELSE [NULL] END AS follower_ids, turn * 1.5::DOUBLE AS ticket_duration_min, turn * 90 / 86400::DOUBLE AS ticket_duration_day
  FROM conversations),
tickets AS (
  SELECT id, created_at, updated_at, description, status, 'high' AS priority, 5::BIGINT AS requester_id, assignee_id, 'group_x' AS group_id, follower_ids, ['T'] AS tags, 'agent' AS support_type, bestellnummer,
    collaborator_id, ticket_duration_min, ticket_duration_day, list({'via_channel': via_channel, 'via_source_rel': NULL::VARCHAR} ORDER BY via_channel) AS via
  FROM turns GROUP BY ALL)"""


def _register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def put(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = sql
        return f

    return put


def _items(spark: SparkSession, sf: str) -> DataFrame:
    return A.financial_items(spark, sf)


# ---- sources and sinks


@_register("read_landed_pages", f"SELECT o_orderkey::VARCHAR AS id, o_totalprice::{_M}::VARCHAR AS amount_value, 'EUR' AS amount_currency_code, o_orderstatus AS status FROM orders")
def _read_landed_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Orders landed as JSON pages, a customer's dealt to several as an API pages them, and read again."""
    one = F.struct(F.col("o_orderkey").cast("string").alias("id"), F.struct(F.col("o_totalprice").cast(_M).cast("string").alias("value"), F.lit("EUR").alias("currency_code")).alias("amount"), F.col("o_orderstatus").alias("status"))
    pages = A.table(spark, sf, "orders").groupBy("o_custkey", F.floor(F.col("o_orderkey") / 1000)).agg(F.collect_list(one).alias("data")).select(F.to_json(F.struct(F.struct("data").alias("data"), F.lit(1).alias("total_pages"))).alias("value"))
    pages.write.text(path := new_path(spark, "pages"))
    schema = "data struct<data: array<struct<id string, amount struct<value string, currency_code string>, status string>>>, total_pages int"
    return landed.read_landed_pages(spark, path, "data.data", schema, multi_line=False)


def _ingested(spark: SparkSession, sf: str) -> str:
    """Orders landed twice as pages, of which every seventh is cut off, lacks its records or comes again under another name, taken in after each landing and once more."""
    one = F.struct(F.col("o_orderkey").cast("string").alias("id"), F.struct(F.col("o_totalprice").cast(_M).cast("string").alias("value")).alias("amount"), F.col("o_orderstatus").alias("status"))
    page = A.table(spark, sf, "orders").groupBy(F.floor(F.col("o_orderkey") / 1000).alias("p")).agg(F.to_json(F.struct(F.array_sort(F.collect_list(one)).alias("data"))).alias("body"))
    flaw = F.col("p") % 7
    pages = page.select("p", F.when(flaw == 3, F.left("body", F.length("body") - 2)).when(flaw == 5, F.format_string('{"page": %d}', "p")).otherwise(F.col("body")).alias("value"))
    path, store = new_path(spark, "landed"), new_path(spark, "ingested")
    # a page of both kinds comes twice in the second landing
    for batch in (pages.filter("p % 5 <> 4"), pages.filter("p % 5 = 4").unionByName(pages.filter("p % 7 = 1")), None):
        if batch is not None:
            batch.select("value").write.mode("append").option("maxRecordsPerFile", 1).text(path)
        ledger.ingest_pages(spark, path, store, "data", "data array<struct<id: string, amount: struct<value: string>, status: string>>")
    return store


@_register("ingest_pages", f"SELECT o_orderkey::VARCHAR AS id, o_totalprice::{_M}::VARCHAR AS amount_value, o_orderstatus AS status FROM orders WHERE (o_orderkey // 1000) % 7 NOT IN (3, 5)")
def _ingest_pages(spark: SparkSession, sf: str) -> DataFrame:
    return ledger.read_records(spark, _ingested(spark, sf)).drop("run")


@_register("ingest_ledger", """
WITH p AS (SELECT o_orderkey // 1000 AS p, count(*) AS n FROM orders GROUP BY ALL),
f AS (SELECT CASE p % 7 WHEN 3 THEN 'malformed' WHEN 5 THEN 'no_records' ELSE 'good' END AS status, CASE WHEN p % 7 IN (3, 5) THEN 0 ELSE n END AS n FROM p UNION ALL SELECT 'repeated', 0 FROM p WHERE p % 7 = 1)
SELECT status, count(*) AS n_files, sum(n) AS n_records FROM f GROUP BY ALL""")
def _ingest_ledger(spark: SparkSession, sf: str) -> DataFrame:
    return ledger.read_ledger(spark, _ingested(spark, sf)).groupBy("status").agg(F.count("*").alias("n_files"), F.sum("n_records").alias("n_records"))


@_register("flatten_struct", f"SELECT o_orderkey::VARCHAR AS transaction_info_transaction_id, o_totalprice::{_M}::VARCHAR AS transaction_info_transaction_amount_value FROM orders")
def _flatten_struct(spark: SparkSession, sf: str) -> DataFrame:
    return landed.flatten_struct(A.raw_payments(spark, sf)).select("transaction_info_transaction_id", "transaction_info_transaction_amount_value")


@_register("stack_by_name", "SELECT c_custkey AS id, c_name AS name, NULL::DOUBLE AS price FROM customer UNION ALL SELECT p_partkey, p_name, p_retailprice FROM part")
def _stack_by_name(spark: SparkSession, sf: str) -> DataFrame:
    c, p = A.table(spark, sf, "customer"), A.table(spark, sf, "part")
    return landed.stack_by_name(c.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")), p.select(F.col("p_retailprice").alias("price"), F.col("p_partkey").alias("id"), F.col("p_name").alias("name")))


@_register("read_clean", "SELECT c_custkey AS c_custkey, lower(trim(c_name)) AS c_name, lower(c_mktsegment) AS c_mktsegment FROM customer")
def _read_clean(spark: SparkSession, sf: str) -> DataFrame:
    """Customers written as CSV with untidy headers, read and cleaned."""
    c = A.table(spark, sf, "customer").select(F.col("c_custkey").alias("C Custkey"), F.concat(F.lit(" "), F.upper("c_name")).alias("cName"), F.upper("c_mktsegment").alias("C-MKTSEGMENT"))
    c.write.csv(path := new_path(spark, "csv"), header=True)
    return landed.read_clean(spark, path, "csv").select(F.col("c_custkey").cast("long").alias("c_custkey"), "c_name", "c_mktsegment")


@_register("write_master", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus <> 'P'")
def _write_master(spark: SparkSession, sf: str) -> DataFrame:
    """Two snapshots, the second computed from the first; the second is read."""
    path = new_path(spark, "master")
    masters.write_master(A.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice"), path)
    masters.write_master(masters.read_master(spark, path).filter("o_orderstatus <> 'P'"), path)
    return masters.read_master(spark, path)


@_register("publish_table", "SELECT o_orderkey, o_orderstatus FROM orders UNION ALL SELECT o_orderkey, o_orderstatus FROM orders")
def _publish_table(spark: SparkSession, sf: str) -> DataFrame:
    """Orders loaded by truncate, then appended once more."""
    target = new_path(spark, "orders").rsplit("/", 1)[-1].replace("-", "_")
    df = A.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    landed.publish_table(df, target, "truncate")
    landed.publish_table(df, target, "append")
    return spark.table(target)


# ---- generic cleaning


@_register("clean_names", "SELECT c_custkey AS x2nd_id, c_name AS full_name, c_acctbal AS percent_paid, c_mktsegment AS number_segment, c_nationkey AS full_name_2 FROM customer")
def _clean_names(spark: SparkSession, sf: str) -> DataFrame:
    c = A.table(spark, sf, "customer")
    return clean.clean_names(c.select(F.col("c_custkey").alias("2nd ID"), F.col("c_name").alias("fullName"), F.col("c_acctbal").alias("% paid"), F.col("c_mktsegment").alias("#Segment"), F.col("c_nationkey").alias("Full Name")))


@_register("normalize_strings", "SELECT doc_id, lower(source) AS source, lower(lang) AS lang, [source] AS kept FROM documents")
def _normalize_strings(spark: SparkSession, sf: str) -> DataFrame:
    pad = lambda c: F.concat(F.lit("\t  "), F.upper(c), F.lit(" 　"))
    d = A.table(spark, sf, "documents")
    return clean.normalize_strings(d.select("doc_id", pad("source").alias("source"), pad("lang").alias("lang"), F.array("source").alias("kept")))


@_register("clean_master", "SELECT o_orderkey AS order_key, lower(o_orderpriority) AS order_priority FROM orders")
def _clean_master(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean_master(A.table(spark, sf, "orders").select(F.col("o_orderkey").alias("orderKey"), F.concat(F.lit(" "), F.col("o_orderpriority")).alias("Order Priority")))


@_register("parse_utc", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderdate END AS at FROM orders")
def _parse_utc(spark: SparkSession, sf: str) -> DataFrame:
    text = F.lower(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return A.table(spark, sf, "orders").select("o_orderkey", X.parse_utc(F.when(F.col("o_orderkey") % 3 == 0, "morgen").otherwise(text)).alias("at"))


@_register("to_number", "SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_acctbal END AS n FROM customer")
def _to_number(spark: SparkSession, sf: str) -> DataFrame:
    return A.table(spark, sf, "customer").select("c_custkey", X.to_number(F.when(F.col("c_custkey") % 4 == 0, "1,5 EUR").otherwise(F.col("c_acctbal").cast("string"))).alias("n"))


@_register("prune_columns", "SELECT o_orderkey, o_totalprice FROM orders")
def _prune_columns(spark: SparkSession, sf: str) -> DataFrame:
    return clean.prune_columns(A.table(spark, sf, "orders"), strict=("o_custkey",), optional=("o_comment", "o_orderstatus"), prefixes=("o_orderd", "o_orderp"))


# ---- cleaners of each source


@_register("clean_payments", f"""
SELECT o_orderkey::VARCHAR AS transaction_id, o_orderdate AS date_updated, lower(o_orderstatus) AS status, 'paypal' AS instrument_type,
  ['paypal wallet', 'rechnung (30 tage)', 'ratenzahlung (3 raten)', 'ratenzahlung (4 raten)', 'ratenzahlung (allgemein)', 'sonstige', NULL][o_orderkey % 7 + 1] AS instrument_sub_type, 'eur' AS currency,
  o_totalprice::{_M}::DOUBLE AS amount, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE -0.35::DOUBLE END AS fee, '10115' AS postal_code, CASE WHEN o_custkey % 3 <> 0 THEN 'de' ELSE 'at' END AS geo_country FROM orders""")
def _clean_payments(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean_payments(landed.flatten_struct(A.raw_payments(spark, sf)))


@_register("clean_returns", f"""
SELECT l_orderkey AS id, l_linenumber AS line, o_orderkey AS shopify_order_id, lower(l_linestatus) AS status, 'return' AS type, l_extendedprice::{_M}::DOUBLE AS refund_amount, l_shipdate AS created_at,
  l_shipdate AS order_completed_date, NULL::TIMESTAMP AS updated_at, o_orderdate AS shopify_created_at, NULL::TIMESTAMP AS fulfilled_at, o_totalprice::{_M}::DOUBLE AS order_amount, 4.9::DOUBLE AS shipping_cost_applied,
  NULL::DOUBLE AS shipping_cost, 'card,voucher,cash' AS payment_method, 'weg ' || l_suppkey || ', 10115 berlin,  ' || lower(o_orderpriority) AS address, lower(o_orderpriority) AS country
FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE l_returnflag = 'R'""")
def _clean_returns(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean_returns(A.raw_returns(spark, sf))


_LINE = f"""l_quantity::DOUBLE AS quantity, l_extendedprice::{_M}::DOUBLE AS price, 'SKU-' || l_partkey AS product_sku, l_returnflag AS product_title, CASE WHEN l_linestatus = 'F' THEN 'Weiß' END AS variant_title,
  l_quantity * l_extendedprice::{_M}::DOUBLE AS item_gross_revenue, l_returnflag || ' - ' || CASE WHEN l_linestatus = 'F' THEN 'Weiß' ELSE 'NA' END AS product_title_with_variant,
  'germany' AS shipping_address_country, 52.5::DOUBLE AS shipping_address_latitude, 13.4::DOUBLE AS shipping_address_longitude, o_custkey AS customer_id, o_orderkey AS order_id, o_orderdate AS created_at,
  o_orderdate AS updated_at, 'eur' AS currency, 0::DOUBLE AS total_discounts, NULL::DOUBLE AS total_tax"""
_ORDERS = f"""
SELECT {_LINE}, l_linenumber::BIGINT AS item_id, '#' || o_orderkey AS shopify_order_name, 'a@b.example' AS identity, 'web' AS sales_channel, CASE WHEN o_orderstatus = 'F' THEN 'paid' ELSE 'pending' END AS financial_status,
  lower(o_orderpriority) AS tags, NULL::VARCHAR AS fulfillment_status, CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE 'PayPal, Gift' END AS payment_method, CASE WHEN o_orderkey % 3 = 0 THEN 'SUMMER, VIP' END AS discount_code,
  o_orderstatus = 'P' AS cancellation_status, CASE WHEN o_orderkey % 5 = 0 THEN TIMESTAMP '2001-01-02' END AS first_refund_datetime, o_totalprice::{_M}::DOUBLE AS total_price, NULL::VARCHAR AS browser_ip,
  NULL::VARCHAR AS landing_site, NULL::VARCHAR AS referring_site FROM orders JOIN lineitem ON o_orderkey = l_orderkey"""


@_register("clean_orders", _ORDERS)
def _clean_orders(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean_orders(A.raw_orders(spark, sf))


@_register("clean_shop", _ORDERS)
def _clean_shop(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean_shop(A.raw_orders(spark, sf), "orders")


@_register("clean_checkouts", f"SELECT {_LINE}, l_partkey AS item_id, 'web' AS source_name, true AS buyer_accepts_marketing, 12::DOUBLE AS total_weight FROM orders JOIN lineitem ON o_orderkey = l_orderkey")
def _clean_checkouts(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean_checkouts(A.raw_orders(spark, sf))


@_register("clean_products", f"""
SELECT p_partkey AS id, lower(p_name) AS title, TIMESTAMP '2023-12-31' AS created_at, p_partkey * 10 + n AS variants_id, CASE n WHEN 1 THEN p_retailprice::{_M}::DOUBLE END AS variants_price,
  n::DOUBLE AS variants_inventory_quantity, 'größe ' || p_size AS variants_title, TIMESTAMP '2023-12-31 23:00:00' AS variants_created_at FROM part, (VALUES (1), (2)) AS v(n)""")
def _clean_products(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean_products(A.raw_products(spark, sf))


@_register("clean_customers", f"SELECT c_custkey AS id, TIMESTAMP '2020-05-06 07:08:09' AS created_at, NULL::TIMESTAMP AS updated_at, c_acctbal::{_M}::DOUBLE AS total_spent, lower(c_mktsegment) AS segment_name FROM customer")
def _clean_customers(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean_customers(A.raw_customers(spark, sf))


@_register("clean_reviews", r"""
SELECT doc_id::VARCHAR AS id, lang AS language, '' AS title, sha256(lower(regexp_replace(text, '^[\s\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{0b}]+|[\s\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{0b}]+$', '', 'g'))) AS text,
  (doc_id % 5 + 1)::DOUBLE AS stars, DATE '2024-01-01' + (doc_id % 365)::INT + TIME '00:00' AS created_at, DATE '2024-01-01' + (doc_id % 365)::INT + TIME '00:00' AS experienced_at, NULL::TIMESTAMP AS updated_at,
  3::DOUBLE AS number_of_likes, (doc_id % 7)::DOUBLE AS consumer_number_of_reviews FROM documents""")
def _clean_reviews(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean_reviews(A.raw_reviews(spark, sf)).withColumn("text", F.sha2("text", 256))


def _tickets(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean_tickets(A.raw_tickets(spark, sf), A.agents(spark), A.groups(spark))


@_register("clean_tickets", f"WITH {TICKETS} SELECT * REPLACE (to_json(follower_ids)::VARCHAR AS follower_ids, array_to_string([x.via_channel for x in via], ',') AS via, tags[1] AS tags) FROM tickets")
def _clean_tickets(spark: SparkSession, sf: str) -> DataFrame:
    return _tickets(spark, sf).withColumns({
        "follower_ids": F.when(F.size(F.array_compact("follower_ids")) == 0, "[null]").otherwise(F.to_json("follower_ids")), "via": F.array_join(F.col("via.via_channel"), ","), "tags": F.col("tags")[0]})


@_register("clean_ticket_export", """
SELECT DISTINCT conv_id::VARCHAR AS id, CASE WHEN conv_id % 2 = 0 THEN 'agent_b' ELSE '77' END AS assignee_id, CASE WHEN conv_id % 3 = 0 THEN 'group_y' ELSE '20000000000021' END AS group_id,
  make_timestamp((1704067200 + conv_id * 60) * 1000000) AS created_at, make_timestamp((1704067200 + conv_id * 60) * 1000000) AS updated_at, NULL::TIMESTAMP AS assigned_at, NULL::TIMESTAMP AS initially_assigned_at,
  NULL::TIMESTAMP AS requester_updated_at, make_timestamp((1704067200 + conv_id * 60) * 1000000) AS solved_at FROM conversations""")
def _clean_ticket_export(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean_ticket_export(A.raw_export(spark, sf), A.agents(spark), A.groups(spark))


@_register("clean_ad_insights", f"""
SELECT DISTINCT ts::DATE AS date, hour(ts)::VARCHAR AS hour, 'acc' AS account_id, user_id::VARCHAR AS campaign_id, 'Camp' AS campaign_name, user_id::VARCHAR AS adset_id, 'Set' AS adset_name, user_id::VARCHAR AS ad_id,
  ['Summer Video', 'STATIC bild', 'Karussell', 'plain', NULL][event_id % 5 + 1] AS ad_name, ['video', 'image', 'carousel', 'ungrouped', 'ungrouped'][event_id % 5 + 1] AS custom_channel_attribute_meta_ads_creative_type,
  CASE WHEN event_id % 11 = 0 THEN 0 ELSE coalesce(value::{_M}::DOUBLE, 0) END AS spend, 1 AS impressions, (event_type = 'click')::INT AS clicks FROM events""")
def _clean_ad_insights(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean_ad_insights(A.raw_ads(spark, sf), "hourly")


@_register("clean_ad_insights_daily", f"""
SELECT DISTINCT ts::DATE AS date_start, 'acc' AS account_id, user_id::VARCHAR AS campaign_id, 'Camp' AS campaign_name, user_id::VARCHAR AS adset_id, 'Set' AS adset_name, user_id::VARCHAR AS ad_id,
  ['Summer Video', 'STATIC bild', 'Karussell', 'plain', NULL][event_id % 5 + 1] AS ad_name,
  CASE WHEN event_id % 11 = 0 THEN 0 ELSE coalesce(value::{_M}::DOUBLE, 0) END AS spend, 1 AS impressions, (event_type = 'click')::INT AS clicks, strftime(ts, '%Y-%m-%d') AS date_stop FROM events""")
def _clean_ad_insights_daily(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean_ad_insights(A.raw_ads(spark, sf), "daily")


@_register("drop_personal", "SELECT c_custkey AS id, c_acctbal AS total_spent FROM customer")
def _drop_personal(spark: SparkSession, sf: str) -> DataFrame:
    c = A.table(spark, sf, "customer")
    return clean.drop_personal(c.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("first_name"), F.col("c_mktsegment").alias("default_address_city"), F.col("c_acctbal").alias("total_spent")), "customers")


# ---- features


@_register("extract_order_number", """
WITH t AS (SELECT conv_id, turn, ['#', '', '12000000 siehe #', '#12000000 oder '][conv_id % 4 + 1] || (12100000 + conv_id) || ' ' || coalesce(text, '') AS x FROM conversations),
u AS (SELECT *, regexp_extract(x, '#(\\d{8})|\\b(\\d{8})\\b', ['a', 'b']) AS p, regexp_extract(x, '#(\\d{8})', 1) AS s FROM t)
SELECT conv_id, turn, coalesce(nullif(nullif(p.a || p.b, ''), '12000000'), nullif(nullif(s, ''), '12000000')) AS n FROM u""".replace("\\\\", "\\"))
def _extract_order_number(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("conv_id")
    lead = F.element_at(F.array(F.lit("#"), F.lit(""), F.lit("12000000 siehe #"), F.lit("#12000000 oder ")), (k % 4 + 1).cast("int"))
    return A.table(spark, sf, "conversations").select("conv_id", "turn", X.extract_order_number(F.concat(lead, (k + 12100000).cast("string")), F.col("text")).alias("n"))


@_register("map_ids", "SELECT c_custkey, CASE WHEN c_custkey::VARCHAR LIKE '1%' THEN 'one' WHEN c_custkey::VARCHAR LIKE '27%' THEN 'two' ELSE c_custkey::VARCHAR END AS prefix, CASE c_custkey WHEN 1 THEN 'one' WHEN 27 THEN 'two' ELSE c_custkey::VARCHAR END AS exact FROM customer")
def _map_ids(spark: SparkSession, sf: str) -> DataFrame:
    names = X.lookup(spark.sql("SELECT * FROM VALUES ('1', 'one'), ('27', 'two') AS t(id, name)"))
    return A.table(spark, sf, "customer").select("c_custkey", X.map_ids(F.col("c_custkey"), names, "prefix").alias("prefix"), X.map_ids(F.col("c_custkey"), names, "exact").alias("exact"))


@_register("join_prefixes", """
WITH t AS (SELECT o_orderkey, o_orderkey::VARCHAR AS t FROM orders), h AS (SELECT o_orderkey, arg_min(p_name, n) AS shortest, arg_max(p_name, n) AS longest FROM t, range(1, 20) AS r(n) JOIN part ON p_partkey::VARCHAR = left(t, n) WHERE n <= length(t) GROUP BY ALL)
SELECT o_orderkey, coalesce(shortest, t) AS shortest, coalesce(longest, t) AS longest FROM t LEFT JOIN h USING (o_orderkey)""")
def _join_prefixes(spark: SparkSession, sf: str) -> DataFrame:
    orders, part = A.table(spark, sf, "orders").select("o_orderkey"), A.table(spark, sf, "part").select("p_partkey", "p_name")
    short = prefixes.join_prefixes(orders, "o_orderkey", part, "shortest", "p_partkey", "p_name")
    return prefixes.join_prefixes(short, "o_orderkey", part, "longest", "p_partkey", "p_name", longest=True)


@_register("classify", "SELECT event_id, ['video', 'image', 'carousel', 'ungrouped', 'ungrouped'][event_id % 5 + 1] AS kind FROM events")
def _classify(spark: SparkSession, sf: str) -> DataFrame:
    names = F.array(F.lit("Summer Video"), F.lit("STATIC bild"), F.lit("Karussell"), F.lit("plain"), F.lit(None).cast("string"))
    return A.table(spark, sf, "events").select("event_id", X.classify(F.lower(F.get(names, (F.col("event_id") % 5).cast("int"))), X.CREATIVE_RULES, F.lit("ungrouped")).alias("kind"))


@_register("last_address_part", "SELECT c_custkey, lower(c_mktsegment) AS country FROM customer")
def _last_address_part(spark: SparkSession, sf: str) -> DataFrame:
    return A.table(spark, sf, "customer").select("c_custkey", X.last_address_part(F.concat(F.col("c_name"), F.lit(", 10115 Berlin,  "), F.col("c_mktsegment"), F.lit(" "))).alias("country"))


@_register("order_array_features", """
SELECT o_orderkey AS id, CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE 'PayPal, Gift' END AS payment_method, CASE WHEN o_orderkey % 3 = 0 THEN 'SUMMER, VIP' END AS discount_code,
  CASE WHEN o_orderkey % 5 = 0 THEN TIMESTAMP '2001-01-02' END AS first_refund, o_orderstatus = 'P' AS cancelled FROM orders""")
def _order_array_features(spark: SparkSession, sf: str) -> DataFrame:
    return A.raw_orders(spark, sf).select("id", X.payment_method(F.col("payment_gateway_names")).alias("payment_method"), X.discount_code(F.col("discount_codes")).alias("discount_code"),
                                          X.first_refund(F.col("refunds")).alias("first_refund"), F.col("cancelled_at").isNotNull().alias("cancelled"))


@_register("durations", "SELECT o_orderkey, l_linenumber, l_partkey, epoch(l_shipdate - o_orderdate) / 60 AS minutes, epoch(l_shipdate - o_orderdate) / 86400 AS days FROM orders JOIN lineitem ON o_orderkey = l_orderkey")
def _durations(spark: SparkSession, sf: str) -> DataFrame:
    o, li = A.table(spark, sf, "orders"), A.table(spark, sf, "lineitem")
    a, b = F.col("o_orderdate").cast("timestamp"), F.col("l_shipdate").cast("timestamp")
    return o.join(li, o["o_orderkey"] == li["l_orderkey"]).select("o_orderkey", "l_linenumber", "l_partkey", X.duration_minutes(a, b).alias("minutes"), X.duration_days(a, b).alias("days"))


@_register("widen_array", "SELECT c_custkey, string_split(c_name, '#')[1] AS parts_1, string_split(c_name, '#')[2] AS parts_2, string_split(c_name, '#')[3] AS parts_3 FROM customer")
def _widen_array(spark: SparkSession, sf: str) -> DataFrame:
    return X.widen_array(A.table(spark, sf, "customer").select("c_custkey", F.split("c_name", "#").alias("parts")), "parts", 3)


# ---- incremental loads


@_register("next_window", "SELECT max(o_orderdate)::DATE - 2 AS start_date, DATE '2002-01-01' AS end_date, true AS due FROM orders")
def _next_window(spark: SparkSession, sf: str) -> DataFrame:
    return upsert.next_window(A.table(spark, sf, "orders"), "o_orderdate", dt.date(2002, 1, 1))


_NEW = "TIMESTAMP '2001-06-01'"


@_register("upsert_latest", f"""
WITH r AS (SELECT 0 AS side, * FROM lineitem WHERE l_shipdate >= {_NEW} UNION ALL SELECT 1, * FROM lineitem)
SELECT l_orderkey, l_linenumber, min(side) AS side, arg_min(l_shipdate, (side, -epoch_us(l_shipdate))) AS l_shipdate FROM r GROUP BY ALL""")
def _upsert_latest(spark: SparkSession, sf: str) -> DataFrame:
    li = A.table(spark, sf, "lineitem")
    new = li.filter("l_shipdate >= timestamp_ntz'2001-06-01'").withColumn("side", F.lit(0))
    return upsert.upsert_latest(new, li.withColumn("side", F.lit(1)), ["l_orderkey", "l_linenumber"], "l_shipdate").select("l_orderkey", "l_linenumber", "side", "l_shipdate")


@_register("append_newer", f"""
WITH old AS (SELECT * FROM orders WHERE o_orderdate < {_NEW}), later AS (SELECT * FROM orders WHERE o_orderdate > (SELECT max(o_orderdate) FROM old))
SELECT DISTINCT o_orderkey, o_orderdate FROM (SELECT * FROM old UNION ALL SELECT * FROM later)""")
def _append_newer(spark: SparkSession, sf: str) -> DataFrame:
    o = A.table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return upsert.append_newer(o, o.filter("o_orderdate < timestamp_ntz'2001-06-01'"), "o_orderdate")


@_register("replace_window", f"WITH {ADS} SELECT DISTINCT date_start, ad_id, CASE WHEN date_start >= DATE '1999-01-20' THEN 2 * spend ELSE spend END::DOUBLE AS spend FROM ads")
def _replace_window(spark: SparkSession, sf: str) -> DataFrame:
    ads = A.ads_daily(spark, sf).select("date_start", "ad_id", F.col("spend").cast("double").alias("spend"))
    start = dt.date(1999, 1, 20)
    return upsert.replace_window(ads, ads.filter(F.col("date_start") >= F.lit(start)).withColumn("spend", F.col("spend") * 2), "date_start", start)


@_register("refresh_source", f"""
SELECT o_orderkey AS id, CASE WHEN o_orderdate >= (SELECT max(o_orderdate)::DATE - 2 FROM orders WHERE o_orderdate < {_NEW}) THEN 'new' ELSE 'old' END AS state, o_orderdate AS updated_at FROM orders""")
def _refresh_source(spark: SparkSession, sf: str) -> DataFrame:
    """A master of orders before June 2001, brought up to date from a landed dump of all orders."""
    o = A.table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("updated_at"))
    path = new_path(spark, "refresh")
    masters.write_master(o.filter("updated_at < timestamp_ntz'2001-06-01'").withColumn("state", F.lit("old")), path)
    refresh_source(spark, path, o, lambda df: df.withColumn("state", F.lit("new")), "upsert", "updated_at", dt.date(2100, 1, 1), ["id"], "updated_at")
    return masters.read_master(spark, path).select("id", "state", "updated_at")


_STATE = f"""SELECT o_orderkey AS id, CASE WHEN o_orderdate {{}} (SELECT {{}} FROM orders WHERE o_orderdate < {_NEW}) THEN 'new' ELSE 'old' END AS state, o_orderdate AS updated_at FROM orders"""


def _refreshed(spark: SparkSession, sf: str, how: str) -> DataFrame:
    """A master of orders before June 2001, stored by day, brought up to date from a landed dump of all orders."""
    o = A.table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("updated_at"))
    path = new_path(spark, "refresh")
    masters.write_master(o.filter("updated_at < timestamp_ntz'2001-06-01'").withColumn("state", F.lit("old")), path, "updated_at", keys=[] if how == "replace" else ["id"], unit="month")
    refresh_source(spark, path, o, lambda df: df.withColumn("state", F.lit("new")), how, "updated_at", dt.date(2001, 12, 31), ["id"], "updated_at", by="updated_at")
    return masters.read_master(spark, path).select("id", "state", "updated_at")


@_register("refresh_by_day", _STATE.format(">=", "max(o_orderdate)::DATE - 2") + " WHERE o_orderdate < TIMESTAMP '2002-01-01'")
def _refresh_by_day(spark: SparkSession, sf: str) -> DataFrame:
    return _refreshed(spark, sf, "upsert")


@_register("refresh_append", _STATE.format(">", "max(o_orderdate)") + " WHERE o_orderdate < TIMESTAMP '2002-01-01'")
def _refresh_append(spark: SparkSession, sf: str) -> DataFrame:
    return _refreshed(spark, sf, "append")


@_register("refresh_replace", _STATE.format(">=", "max(o_orderdate)::DATE - 2") + " WHERE o_orderdate < TIMESTAMP '2002-01-01'")
def _refresh_replace(spark: SparkSession, sf: str) -> DataFrame:
    return _refreshed(spark, sf, "replace")


_LINES = "SELECT CASE WHEN l_orderkey % 50 = 0 THEN NULL ELSE l_orderkey END AS order_id, nullif(l_linenumber, 3) AS line, l_shipdate FROM lineitem"


@_register("refresh_composite", f"""
WITH k AS ({_LINES}), r AS (
  SELECT 0 AS side, * FROM k WHERE l_shipdate >= (SELECT max(l_shipdate)::DATE - 2 FROM k WHERE l_shipdate < {_NEW}) AND l_shipdate < TIMESTAMP '2002-01-01'
  UNION ALL SELECT 1, * FROM k WHERE l_shipdate < {_NEW})
SELECT order_id, line, min(side) AS side, arg_min(l_shipdate, (side, -epoch_us(l_shipdate))) AS l_shipdate FROM r GROUP BY ALL""")
def _refresh_composite(spark: SparkSession, sf: str) -> DataFrame:
    """Lines with two keys, both null at times, as a master stored by day: the first refresh makes its keys unique and its directory, the second finds the days of its keys in that."""
    li = A.table(spark, sf, "lineitem").select(F.when(F.col("l_orderkey") % 50 != 0, F.col("l_orderkey")).alias("order_id"), F.nullif("l_linenumber", F.lit(3)).alias("line"), "l_shipdate")
    path, before = new_path(spark, "lines"), "l_shipdate < timestamp_ntz'2001-06-01'"
    masters.write_master(li.filter(before).withColumn("side", F.lit(1)), path, "l_shipdate", unit="month")
    for last in (dt.date(2001, 5, 31), dt.date(2001, 12, 31)):
        refresh_source(spark, path, li, lambda df: df.withColumn("side", F.lit(0)), "upsert", "l_shipdate", last, ["order_id", "line"], "l_shipdate", by="l_shipdate")
    return masters.read_master(spark, path).select("order_id", "line", "side", "l_shipdate")


@_register("stream_upserts", f"SELECT o_orderkey AS id, CASE WHEN o_orderdate >= {_NEW} THEN 'new' ELSE 'old' END AS state, o_orderdate AS updated_at FROM orders")
def _stream_upserts(spark: SparkSession, sf: str) -> DataFrame:
    """All orders as a master stored by day, and those from June 2001 on landed as files that a stream merges into it."""
    o = A.table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("updated_at"))
    path, inbox = new_path(spark, "streamed"), new_path(spark, "inbox")
    masters.write_master(o.withColumn("state", F.lit("old")), path, "updated_at", keys=["id"], unit="month")
    new = o.filter("updated_at >= timestamp_ntz'2001-06-01'").withColumn("state", F.lit("new"))
    new.write.parquet(inbox)
    stream_upserts(spark, inbox, new.schema, path, new_path(spark, "progress"), ["id"], updated="updated_at", by="updated_at").awaitTermination()
    return masters.read_master(spark, path).select("id", "state", "updated_at")


# ---- analytics


@_register("order_date_violations", "SELECT l_orderkey AS order_id, min(l_shipdate) AS first, max(l_shipdate) AS last, count(DISTINCT l_shipdate) AS dates FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY ALL HAVING count(DISTINCT l_shipdate) > 1")
def _order_date_violations(spark: SparkSession, sf: str) -> DataFrame:
    """Items that take their shipping date for the order's, which the check must find."""
    return daily.order_date_violations(_items(spark, sf).withColumn("created_at", F.col("shipped_at")))


@_register("new_customer_flag", f"WITH {ITEMS}, {FLAGS} SELECT * FROM flags")
def _new_customer_flag(spark: SparkSession, sf: str) -> DataFrame:
    return daily.new_customer_flag(_items(spark, sf))


@_register("daily_items", f"WITH {ITEMS}, {FLAGS}, {D_ITEMS} SELECT * FROM d_items")
def _daily_items(spark: SparkSession, sf: str) -> DataFrame:
    return daily.daily_items(_items(spark, sf))


@_register("daily_orders", f"WITH {ITEMS}, {FLAGS}, {D_ORDERS} SELECT * FROM d_orders")
def _daily_orders(spark: SparkSession, sf: str) -> DataFrame:
    return daily.daily_orders(_items(spark, sf))


@_register("daily_refunds", f"WITH {RETURNS}, {D_REFUNDS} SELECT * FROM d_refunds")
def _daily_refunds(spark: SparkSession, sf: str) -> DataFrame:
    return daily.daily_refunds(A.returns_clean(spark, sf))


@_register("daily_refunds_by_conversion", f"WITH {RETURNS} SELECT shopify_created_at::DATE AS date, sum(refund_amount)::DOUBLE AS refunds FROM returns WHERE status = 'refunded' AND type IN ('return', 'mix') GROUP BY ALL")
def _daily_refunds_by_conversion(spark: SparkSession, sf: str) -> DataFrame:
    return daily.daily_refunds(A.returns_clean(spark, sf), "conversion_date")


@_register("daily_spend", f"WITH {ADS}, {D_SPEND} SELECT * FROM d_spend")
def _daily_spend(spark: SparkSession, sf: str) -> DataFrame:
    return daily.daily_spend(A.ads_daily(spark, sf))


_BUSINESS = f"""
WITH {ITEMS}, {RETURNS}, {ADS}, {FLAGS}, {D_ITEMS}, {D_ORDERS}, {D_REFUNDS}, {D_SPEND},
e AS (SELECT date, coalesce(gross_revenue, 0)::{_M} AS g, coalesce(taxes, 0)::{_M} AS t, coalesce(refunds, 0)::{_M} AS r, coalesce(product_costs, 0)::{_M} AS p, coalesce(transaction_costs, 0)::{_M} AS tc,
    coalesce(fulfillment_costs, 0)::{_M} AS fc, coalesce(channel_spend, 0)::{_M} AS s, coalesce(channel_impressions, 0) AS channel_impressions, coalesce(channel_clicks, 0) AS channel_clicks,
    coalesce(gross_orders, 0) AS gross_orders, coalesce(nc_gross_orders, 0) AS nc_gross_orders, coalesce(nc_gross_revenue, 0) AS nc_gross_revenue, coalesce(gross_quantity, 0) AS gross_quantity
  FROM d_items FULL JOIN d_orders USING (date) FULL JOIN d_refunds USING (date) FULL JOIN d_spend USING (date))
SELECT date, g::DOUBLE AS gross_revenue, t::DOUBLE AS taxes, r::DOUBLE AS refunds, (g - t - r)::DOUBLE AS net_revenue, p::DOUBLE AS product_costs, (g - t - r - p)::DOUBLE AS cm1, tc::DOUBLE AS transaction_costs,
  fc::DOUBLE AS fulfillment_costs, (g - t - r - p - tc - fc)::DOUBLE AS cm2, s::DOUBLE AS channel_spend, (g - t - r - p - tc - fc - s)::DOUBLE AS cm3, channel_impressions, channel_clicks, gross_orders, nc_gross_orders,
  nc_gross_revenue, gross_quantity FROM e ORDER BY date"""


@_register("daily_business", _BUSINESS)
def daily_business(spark: SparkSession, sf: str) -> DataFrame:
    return daily.daily_business(_items(spark, sf), A.returns_clean(spark, sf), A.ads_daily(spark, sf))


@_register("daily_business_incremental", _BUSINESS)
def _daily_business_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """The same table from a view: made of items of which a seventh is late, some were sold otherwise, and some never, and of half the returns and ads; then refreshed as the masters come right."""
    returns, ads = A.returns_clean(spark, sf), A.ads_daily(spark, sf)
    _items(spark, sf).write.parquet(sold := new_path(spark, "sold"))  # read four times below, joined once
    items = spark.read.parquet(sold)
    places = {n: new_path(spark, n) for n in ("items", "returns", "ads", "view")}
    k, keys = F.col("order_id"), ["order_id", "item_id", "part_id", "shipped_at"]
    recent, start = F.col("created_at") >= F.lit(dt.datetime(2001, 3, 1)), dt.date(2001, 3, 1)
    changed = (k % 5 == 0) & (k % 3 == 0)
    first = items.filter(k % 7 != 0).withColumn("quantity", F.when(changed, F.col("quantity") + 1).otherwise(F.col("quantity")).cast("decimal(18,4)"))
    never = items.filter(recent & (k % 4 == 0)).withColumns({"order_id": -k, "item_gross_revenue": F.lit(1).cast("decimal(18,4)")})
    masters.write_master(first.unionByName(never), places["items"], "created_at", keys=keys, unit="month")
    masters.write_master(returns.filter(F.col("order_completed_date") < F.lit(dt.datetime(2000, 1, 1))), places["returns"], "order_completed_date", unit="month")
    masters.write_master(ads.filter(F.crc32("ad_id") % 2 == 0), places["ads"], "date_start", keys=["ad_id"], unit="month")

    def refresh() -> None:
        refresh_daily_view(spark, places["view"], places["items"], places["returns"], places["ads"])

    refresh()
    items.filter((k % 7 == 0) | changed).write.parquet(late := new_path(spark, "late"))
    upsert_into(spark, places["items"], spark.read.parquet(late), keys, by="created_at")
    masters.write_master(returns.filter(F.col("order_completed_date") >= F.lit(dt.datetime(2000, 1, 1))), places["returns"], "order_completed_date", [], unit="month")
    items.filter(recent).write.parquet(true := new_path(spark, "true"))
    merge_into(spark, places["items"], spark.read.parquet(true), lambda new, old: upsert.replace_window(old, new, "created_at", start), keys, "created_at", masters.held_days(masters.manifest(spark, places["items"]), start, dt.date.max))
    ads.filter(F.crc32("ad_id") % 2 == 1).write.parquet(more := new_path(spark, "more"))
    upsert_into(spark, places["ads"], spark.read.parquet(more), ["ad_id"], by="date_start")
    refresh()
    return read_daily_view(spark, places["view"])


def _weekly(spark: SparkSession, sf: str) -> DataFrame:
    return market.weekly_ohlc(_items(spark, sf), A.returns_clean(spark, sf))


_W = f"WITH {ITEMS}, {RETURNS}, {WEEKLY} SELECT week_start, open, high, low, close, volume"


@_register("weekly_ohlc", f"{_W} FROM v")
def _weekly_ohlc(spark: SparkSession, sf: str) -> DataFrame:
    return _weekly(spark, sf)


@_register("volume_spread_color", f"{_W}, bullish, vol_sma4, fill_color FROM v")
def _volume_spread_color(spark: SparkSession, sf: str) -> DataFrame:
    return market.volume_spread_color(_weekly(spark, sf))


@_register("sma_crossovers", f"{_W}, sma_fast, sma_slow, cross_up, cross_dn, is_crossover FROM v")
def _sma_crossovers(spark: SparkSession, sf: str) -> DataFrame:
    return market.sma_crossovers(_weekly(spark, sf))


@_register("rsi", f"{_W}, change, gain, loss, avg_gain, avg_loss, rs, rsi FROM v")
def _rsi(spark: SparkSession, sf: str) -> DataFrame:
    return market.rsi(_weekly(spark, sf))


@_register("weekly_market_view", f"WITH {ITEMS}, {RETURNS}, {WEEKLY} SELECT * FROM v ORDER BY week_start")
def _weekly_market_view(spark: SparkSession, sf: str) -> DataFrame:
    return market.weekly_market_view(_items(spark, sf), A.returns_clean(spark, sf))


_THEMES = r"""r AS (SELECT CASE WHEN doc_id % 5 + 1 <= 3 THEN 'Kritisch (1-3)' ELSE 'Positiv (4-5)' END AS rating_group, unnest(string_split_regex(text, '[^\p{L}]+')) AS w FROM documents WHERE lang = 'de'),
c AS (SELECT rating_group, lower(w) AS word, count(*) AS n FROM r WHERE regexp_matches(w, '^\p{Lu}') AND lower(w) NOT IN ('schuh', 'frist', 'juli', 'kontaktformular') GROUP BY ALL),
t AS (SELECT *, n / sum(n) OVER (PARTITION BY rating_group) AS tf, ln((SELECT count(DISTINCT rating_group) FROM c) / count(*) OVER (PARTITION BY word)) AS idf FROM c)"""


@_register("noun_themes", f"WITH {_THEMES} SELECT rating_group, word, n, tf, idf, tf * idf AS tf_idf FROM t QUALIFY row_number() OVER (PARTITION BY rating_group ORDER BY tf * idf DESC, n DESC, word) <= 10")
def _noun_themes(spark: SparkSession, sf: str) -> DataFrame:
    return themes.noun_themes(A.raw_reviews(spark, sf))


@_register("tf_idf", f"WITH {_THEMES} SELECT rating_group, word, n, tf, idf, tf * idf AS tf_idf FROM t")
def _tf_idf(spark: SparkSession, sf: str) -> DataFrame:
    return themes.tf_idf(themes.theme_counts(A.raw_reviews(spark, sf)), "rating_group", "word", "n")


_CLOSED = " ".join(f"WHEN lower(word) IN {tuple(words)}".replace(",)", ")") + f" THEN '{name}'" for name, words in A.CLOSED.items())
_TRIES = "SELECT {0}, w, {0} || '=' || w AS key, 99 AS o FROM {1} UNION ALL SELECT {0}, w, {0} || '~' || right(w, e), e FROM {1}, range(5) AS r(e) WHERE e <= length(w)"
_TAGGED = rf"""
p AS (SELECT doc_id, unnest(string_split_regex(text, '[.!?\n]+')) AS part, generate_subscripts(string_split_regex(text, '[.!?\n]+'), 1) - 1 AS sent FROM documents WHERE lang = 'de'),
tok AS (SELECT doc_id, sent, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS pos FROM (SELECT doc_id, sent, list_filter(string_split_regex(part, '[^\p{{L}}]+'), lambda x: x <> '') AS words FROM p)),
k AS (SELECT *, lower(word) AS w, CASE WHEN pos = 0 THEN '?' WHEN regexp_matches(word, '^\p{{Lu}}') THEN '^' ELSE '_' END AS mark, regexp_replace(lower(word), '(ung|heit|keit)en$', '\1') AS lem,
  CASE {_CLOSED} WHEN regexp_matches(lower(word), '(ung|heit|keit)(en)?$') THEN 'NOUN' WHEN regexp_matches(lower(word), '(lich|isch)$') THEN 'ADJ' ELSE 'X' END AS tag FROM tok),
tags AS (SELECT tag, count(*) AS total, count(DISTINCT w) AS types FROM k GROUP BY ALL),
seen AS (SELECT '?' AS mark, w, tag FROM k UNION ALL SELECT mark, w, tag FROM k WHERE mark <> '?'),
whole AS (SELECT mark || '=' || w AS key, tag, count(*) AS n FROM seen GROUP BY ALL),
ends AS (SELECT mark || '~' || right(w, e) AS key, tag, count(*) AS n FROM (SELECT DISTINCT * FROM seen), range(5) AS r(e) WHERE e <= length(w) GROUP BY ALL),
kept AS (SELECT key FROM (SELECT key, sum(n) AS n FROM whole GROUP BY key ORDER BY n DESC, key LIMIT 100000) UNION ALL SELECT key FROM (SELECT key, sum(n) AS n FROM ends GROUP BY key ORDER BY n DESC, key LIMIT 50000)),
heads AS (SELECT * FROM (FROM whole UNION ALL FROM ends) SEMI JOIN kept USING (key)),
need AS (SELECT DISTINCT mark, w FROM k),
found AS (SELECT mark, w, arg_max(key, o) AS key FROM ({_TRIES.format("mark", "need")}) SEMI JOIN kept USING (key) GROUP BY ALL),
em AS (SELECT mark, w, t.tag, floor(1000 * ln((coalesce(n, 0) + 0.01::DOUBLE) / (CASE WHEN key[2] = '=' THEN total ELSE types END + 1)))::BIGINT AS s FROM found CROSS JOIN tags AS t LEFT JOIN heads USING (key, tag)),
moved AS (SELECT a, b, count(*) AS n FROM (SELECT coalesce(lag(tag) OVER (PARTITION BY doc_id, sent ORDER BY pos), '') AS a, tag AS b FROM k) GROUP BY ALL),
moves AS (SELECT a, b, floor(1000 * ln((coalesce(n, 0) + 1::DOUBLE) / (sum(coalesce(n, 0)) OVER (PARTITION BY a) + (SELECT count(*) FROM tags))))::BIGINT AS s
  FROM (SELECT '' AS a UNION ALL SELECT tag FROM tags) CROSS JOIN (SELECT tag AS b FROM tags) LEFT JOIN moved USING (a, b)),
step AS MATERIALIZED (SELECT doc_id, sent, pos, em.tag, em.s FROM k JOIN em USING (mark, w)),
vit AS (
  SELECT doc_id, sent, pos, tag, step.s + moves.s AS score, [tag] AS path FROM step JOIN moves ON a = '' AND b = tag WHERE pos = 0
  UNION ALL
  SELECT doc_id, sent, pos, tag, score, path FROM (
    SELECT e.doc_id, e.sent, e.pos, e.tag, v.score + m.s + e.s AS score, list_append(v.path, e.tag) AS path,
      row_number() OVER (PARTITION BY e.doc_id, e.sent, e.tag ORDER BY v.score + m.s DESC, v.tag) AS r
    FROM vit AS v JOIN step AS e ON e.doc_id = v.doc_id AND e.sent = v.sent AND e.pos = v.pos + 1 JOIN moves AS m ON m.a = v.tag AND m.b = e.tag) WHERE r = 1),
ended AS (SELECT doc_id, sent, path FROM vit QUALIFY row_number() OVER (PARTITION BY doc_id, sent ORDER BY pos DESC, score DESC, tag) = 1),
upos AS (SELECT doc_id, sent, unnest(path) AS upos, generate_subscripts(path, 1) - 1 AS pos FROM ended),
rule AS (SELECT tag, w, n, length(w) - same AS cut, substr(lem, (same + 1)::BIGINT) AS added
  FROM (SELECT tag, w, lem, count(*) AS n, len(list_filter(range(least(length(w), length(lem)) + 1), lambda i: left(w, i) = left(lem, i))) - 1 AS same FROM k GROUP BY tag, w, lem)),
rkeys AS (SELECT tag || '=' || w AS key, true AS known, cut, added, sum(n) AS n FROM rule GROUP BY ALL UNION ALL
  SELECT tag || '~' || right(w, e), false, cut, added, count(*) FROM rule, range(5) AS r(e) WHERE e <= length(w) GROUP BY ALL),
rtop AS (SELECT key, known, cut, added FROM (SELECT *, sum(n) OVER (PARTITION BY key) AS all_n, row_number() OVER (PARTITION BY key ORDER BY n DESC, cut, added) AS r FROM rkeys) WHERE r = 1
  QUALIFY row_number() OVER (PARTITION BY known ORDER BY all_n DESC, key) <= CASE WHEN known THEN 100000 ELSE 50000 END),
uneed AS (SELECT DISTINCT upos, w FROM k JOIN upos USING (doc_id, sent, pos)),
lemmas AS (SELECT upos, w, CASE WHEN cut <= length(w) THEN left(w, length(w) - cut) || added ELSE w END AS lemma
  FROM (SELECT upos, w, arg_max(key, o) AS key FROM ({_TRIES.format("upos", "uneed")}) SEMI JOIN rtop USING (key) GROUP BY ALL) JOIN rtop USING (key)),
tagged AS (SELECT doc_id, sent, pos, word, upos, lemma FROM k JOIN upos USING (doc_id, sent, pos) JOIN lemmas USING (upos, w))"""


@_register("tag_sentences", f"WITH RECURSIVE {_TAGGED} SELECT doc_id, sent, pos, word, upos, lemma FROM tagged")
def _tag_sentences(spark: SparkSession, sf: str) -> DataFrame:
    texts = A.table(spark, sf, "documents").filter("lang = 'de'").select("doc_id", "text")
    return tagger.tag_sentences(texts, tagger.train_tagger(A.tagged_sentences(spark, sf)))


@_register("noun_themes_tagged", f"""WITH RECURSIVE {_TAGGED},
c AS (SELECT CASE WHEN doc_id % 5 + 1 <= 3 THEN 'Kritisch (1-3)' ELSE 'Positiv (4-5)' END AS rating_group, lemma AS word, count(*) AS n FROM tagged
  WHERE upos = 'NOUN' AND lemma NOT IN ('schuh', 'frist', 'juli', 'kontaktformular') GROUP BY ALL),
t AS (SELECT *, n / sum(n) OVER (PARTITION BY rating_group) AS tf, ln((SELECT count(DISTINCT rating_group) FROM c) / count(*) OVER (PARTITION BY word)) AS idf FROM c)
SELECT rating_group, word, n, tf, idf, tf * idf AS tf_idf FROM t QUALIFY row_number() OVER (PARTITION BY rating_group ORDER BY tf * idf DESC, n DESC, word) <= 10""")
def _noun_themes_tagged(spark: SparkSession, sf: str) -> DataFrame:
    model = tagger.train_tagger(A.tagged_sentences(spark, sf))
    return themes.noun_themes(A.raw_reviews(spark, sf), lambda texts: tagger.tag_sentences(texts, model))


@_register("top_k_per_group", "SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) <= 3")
def _top_k_per_group(spark: SparkSession, sf: str) -> DataFrame:
    return themes.top_k_per_group(A.table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice"), "o_custkey", [F.desc("o_totalprice"), F.col("o_orderkey")], 3)


_U = "((('0x' || substr(md5('1:{}:' || id), 1, 12))::BIGINT + 0.5::DOUBLE) / 16::DOUBLE ** 12)"
_PRIZES = ", ".join(f"('{n}', {c})" for n, c in draw.PRIZES)


@_register("weighted_draw", f"""
WITH p AS (SELECT prize, sum(n) OVER (ORDER BY i) - n AS a, sum(n) OVER (ORDER BY i) AS b FROM (SELECT col0 AS prize, col1 AS n, row_number() OVER () AS i FROM (VALUES {_PRIZES}))),
k AS (SELECT sum(n) AS total FROM (VALUES {_PRIZES}) AS v(x, n)),
e AS (SELECT o_orderkey::VARCHAR AS id, 'x@y.example' AS email, o_orderpriority AS first_name, '' AS last_name, floor(greatest(o_totalprice, 0) / 10000)::BIGINT AS amount_lose FROM orders),
w AS (SELECT * FROM e WHERE amount_lose > 0 QUALIFY row_number() OVER (ORDER BY -ln({_U.format("draw")}) / amount_lose, id) <= (SELECT total FROM k)),
r AS (SELECT *, row_number() OVER (ORDER BY {_U.format("prize")}, id) - 1 AS rank FROM w)
SELECT id, email, first_name, last_name, amount_lose, prize FROM r JOIN p ON rank >= a AND rank < b""")
def _weighted_draw(spark: SparkSession, sf: str) -> DataFrame:
    return draw.weighted_draw(A.entrants(spark, sf))


@_register("find_duplicates", "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem QUALIFY count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1")
def _find_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return support.find_duplicates(A.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), ["l_orderkey", "l_linenumber"])


@_register("tickets_by_agent", f"WITH {TICKETS} SELECT assignee_id, status, count(*) AS n_tickets, count(DISTINCT id) AS n_distinct FROM tickets WHERE assignee_id IS NOT NULL GROUP BY ALL")
def _tickets_by_agent(spark: SparkSession, sf: str) -> DataFrame:
    return support.tickets_by_agent(_tickets(spark, sf))


@_register("duration_box_stats", f"""
WITH {TICKETS}, o AS (SELECT DISTINCT id, created_at, updated_at, description, status, assignee_id, bestellnummer, ticket_duration_min AS x, via FROM tickets WHERE assignee_id IS NOT NULL OR status <> 'new'),
q AS (SELECT assignee_id, status, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median, quantile_cont(x, 0.75) AS q3 FROM o GROUP BY ALL),
j AS (SELECT o.*, q1, median, q3, x >= q1 - 1.5 * (q3 - q1) AND x <= q3 + 1.5 * (q3 - q1) AS inside FROM o JOIN q ON o.assignee_id IS NOT DISTINCT FROM q.assignee_id AND o.status = q.status)
SELECT assignee_id, status, count(x) AS n, min(x) FILTER (inside) AS whisker_low, any_value(q1) AS q1, any_value(median) AS median, any_value(q3) AS q3, max(x) FILTER (inside) AS whisker_high,
  count(*) FILTER (NOT inside) AS outliers FROM j GROUP BY ALL""")
def _duration_box_stats(spark: SparkSession, sf: str) -> DataFrame:
    return support.duration_box_stats(_tickets(spark, sf))
