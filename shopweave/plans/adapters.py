"""The driver's test tables in the shape of the operators' input contracts.

Money is built from exact decimals per row. Raw records carry the flaws that the
cleaners are for: padded and upper-case text, numbers and times as text, bad values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopweave.operators import tagger
from shopweave.session import dealt

MONEY = "decimal(18,4)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _money(c: Column) -> Column:
    return c.cast(MONEY)


def _at(c: Column) -> Column:
    """A time as the text that APIs send."""
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def _ordered_lines(spark: SparkSession, sf_dir: str, where: str = "true") -> DataFrame:
    """Lines with their orders, by order: what groups or joins them by order next stays in its tasks."""
    o, li = dealt(table(spark, sf_dir, "orders"), "o_orderkey"), dealt(table(spark, sf_dir, "lineitem").filter(where), "l_orderkey")
    return o.join(li, o["o_orderkey"] == li["l_orderkey"])


def financial_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their order's amounts repeated on each."""
    ext, one = _money(F.col("l_extendedprice")), F.lit(1)
    net = _money(ext * (one - _money(F.col("l_discount"))))
    status = F.when(F.col("o_orderstatus") == "F", "paid").when(F.col("o_orderstatus") == "O", "partially_paid").otherwise("pending")
    return _ordered_lines(spark, sf_dir).select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"), F.col("o_orderdate").alias("created_at"),
        (F.col("o_orderstatus") == "P").alias("cancellation_status"), status.alias("financial_status"), F.col("l_linenumber").alias("item_id"),
        _money(net * (one + _money(F.col("l_tax")))).alias("item_gross_revenue"), net.alias("item_net_revenue"),
        _money(ext * F.lit("0.40").cast("decimal(4,2)")).alias("total_cogs"), _money(F.lit("4.90")).alias("total_shipping_cost"),
        _money(F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("1.50")).otherwise(F.lit("0.80"))).alias("total_packaging"),
        _money(_money(F.col("o_totalprice")) * F.lit("0.02").cast("decimal(4,2)")).alias("total_payment_fees"), _money(F.col("l_quantity")).alias("quantity"),
        F.col("l_shipdate").alias("shipped_at"), F.col("l_partkey").alias("part_id"))


def returns_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returned lines as cleaned returns."""
    kind = F.element_at(F.array(F.lit("return"), F.lit("mix"), F.lit("exchange")), (F.col("l_linenumber") % 3 + 1).cast("int"))
    return _ordered_lines(spark, sf_dir, "l_returnflag = 'R'").select(
        F.col("o_orderkey").alias("shopify_order_id"), F.when(F.col("l_linestatus") == "F", "refunded").otherwise("open").alias("status"), kind.alias("type"),
        F.col("l_shipdate").alias("order_completed_date"), F.col("o_orderdate").alias("shopify_created_at"),
        _money(_money(F.col("l_extendedprice")) * (F.lit(1) - _money(F.col("l_discount")))).alias("refund_amount"))


def ads_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as ad spend, 9,131 days earlier so that they meet the orders."""
    e = table(spark, sf_dir, "events")
    return e.select(F.date_sub(F.to_date("ts"), 9131).alias("date_start"), F.col("event_id").cast("string").alias("ad_id"), _money(F.col("value")).alias("spend"),
                    F.lit(1).alias("impressions"), (F.col("event_type") == "click").cast("int").alias("clicks"))


def raw_ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    names = F.array(F.lit("Summer Video"), F.lit("STATIC bild"), F.lit("Karussell"), F.lit("plain"), F.lit(None).cast("string"))
    n = F.col("user_id").cast("string")
    return e.select(
        F.date_format("ts", "yyyy-MM-dd").alias("date_start"), F.date_format("ts", "yyyy-MM-dd").alias("date_stop"),
        F.concat(F.date_format("ts", "HH"), F.lit(":00:00 - "), F.date_format("ts", "HH"), F.lit(":59:59")).alias("hourly_stats_aggregated_by_advertiser_time_zone"),
        F.lit("acc").alias("account_id"), n.alias("campaign_id"), F.lit("Camp").alias("campaign_name"), n.alias("adset_id"), F.lit("Set").alias("adset_name"),
        n.alias("ad_id"), F.get(names, (F.col("event_id") % 5).cast("int")).alias("ad_name"),
        F.when(F.col("event_id") % 11 == 0, "n/a").otherwise(_money(F.col("value")).cast("string")).alias("spend"), F.lit("1").alias("impressions"),
        F.when(F.col("event_type") == "click", "1").alias("clicks"))


def raw_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One nested payment record per order."""
    kinds = F.array(*[F.lit(x) for x in (" PayPal WALLET", "Rechnung in 30 Tagen", "Pay in 3", "4x gratis", "Ratenzahlung ", "Sonstige")], F.lit(None).cast("string"))
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        F.struct(
            key.cast("string").alias("transaction_id"), _at(F.col("o_orderdate")).alias("transaction_initiation_date"), _at(F.col("o_orderdate")).alias("transaction_updated_date"),
            F.concat(F.col("o_orderstatus"), F.lit(" ")).alias("transaction_status"), F.lit("PAYPAL").alias("instrument_type"), F.get(kinds, (key % 7).cast("int")).alias("instrument_sub_type"),
            F.struct(F.lit("EUR").alias("currency_code"), _money(F.col("o_totalprice")).cast("string").alias("value")).alias("transaction_amount"),
            F.struct(F.when(key % 13 == 0, "none").otherwise(F.lit("-0.35")).alias("value")).alias("fee_amount")).alias("transaction_info"),
        F.struct(
            F.when(F.col("o_custkey") % 3 != 0, "DE").alias("country_code"), F.struct(F.lit(" 10115").alias("postal_code")).alias("address"),
            F.struct(F.lit("AT").alias("country_code")).alias("phone_number")).alias("payer_info"))


def raw_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw return per returned line, personal columns included."""
    o, li = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'")
    private = ("shopify_order_path", "full_name", "phone", "shopify_new_order_path", "deleted_at", "delivered_at", "requested_wrong_items", "draft_order_id",
               "draft_order_name", "tracking_number", "barcode_number", "email")
    text = lambda c: _money(F.col(c)).cast("string")
    return o.join(li, o["o_orderkey"] == li["l_orderkey"]).select(
        F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("line"), F.col("o_orderkey").alias("shopify_order_id"), F.upper("l_linestatus").alias("status"), F.lit("Return").alias("type"),
        _money(F.col("l_extendedprice")).cast("double").alias("refund_amount"), _at(F.col("l_shipdate")).alias("created_at"), _at(F.col("l_shipdate")).alias("order_completed_date"),
        F.lit("kein Datum").alias("updated_at"), _at(F.col("o_orderdate")).alias("shopify_created_at"), F.lit(None).cast("string").alias("fulfilled_at"),
        text("o_totalprice").alias("order_amount"), F.lit("4.9").alias("shipping_cost_applied"), F.lit("x").alias("shipping_cost"), F.lit("Card,  Voucher, Cash").alias("payment_method"),
        F.concat(F.lit("Weg "), F.col("l_suppkey").cast("string"), F.lit(", 10115 Berlin,  "), F.col("o_orderpriority")).alias("address"), *[F.lit("privat").alias(c) for c in private])


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    one = F.struct(
        F.col("l_linenumber").cast("long").alias("id"), F.concat(F.lit("SKU-"), F.col("l_partkey").cast("string")).alias("sku"), F.col("l_returnflag").alias("title"),
        F.when(F.col("l_linestatus") == "F", "Weiß").alias("variant_title"), F.col("l_quantity").cast("long").alias("quantity"), _money(F.col("l_extendedprice")).cast("string").alias("price"),
        F.col("l_partkey").alias("product_id"))
    return li.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(one)).alias("line_items"))


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their lines in an array; orders without a line have an empty one."""
    o, none = table(spark, sf_dir, "orders"), F.lit(None).cast("string")
    lines = _lines(spark, sf_dir)
    kind = lines.schema["line_items"].dataType.simpleString()
    key = F.col("o_orderkey")
    return o.join(lines, o["o_orderkey"] == lines["l_orderkey"], "left").select(
        key.alias("id"), F.concat(F.lit("#"), key.cast("string")).alias("name"), F.lit("A@B.example").alias("email"), _at(F.col("o_orderdate")).alias("created_at"),
        _at(F.col("o_orderdate")).alias("updated_at"), F.when(F.col("o_orderstatus") == "P", _at(F.col("o_orderdate"))).alias("cancelled_at"), F.lit("WEB").alias("source_name"),
        F.when(F.col("o_orderstatus") == "F", "PAID").otherwise("Pending").alias("financial_status"), none.alias("fulfillment_status"), F.col("o_orderpriority").alias("tags"), F.lit("EUR").alias("currency"),
        none.alias("browser_ip"), none.alias("landing_site"), none.alias("referring_site"), _money(F.col("o_totalprice")).cast("string").alias("total_price"), F.lit("0.00").alias("total_discounts"),
        F.lit("bad").alias("total_tax"), F.lit("12").alias("total_weight"), F.lit(True).alias("buyer_accepts_marketing"),
        F.when(key % 4 == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("PayPal"), F.lit("Gift"))).alias("payment_gateway_names"),
        F.when(key % 3 == 0, F.array(F.struct(F.lit("SUMMER").alias("code")), F.struct(F.lit("VIP").alias("code")))).otherwise(F.array().cast("array<struct<code:string>>")).alias("discount_codes"),
        F.when(key % 5 == 0, F.array(F.struct(F.lit("2001-02-03T04:05:06Z").alias("created_at")), F.struct(F.lit("2001-01-02T00:00:00Z").alias("created_at")))).otherwise(
            F.array().cast("array<struct<created_at:string>>")).alias("refunds"),
        F.col("o_custkey").alias("customer_id"), F.lit("Germany").alias("shipping_address_country"), F.lit(52.5).alias("shipping_address_latitude"), F.lit(13.4).alias("shipping_address_longitude"),
        F.coalesce("line_items", F.array().cast(kind)).alias("line_items"))


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One product per part with two variants each."""
    p = table(spark, sf_dir, "part")
    variant = lambda n, price: F.struct(
        (F.col("p_partkey") * 10 + n).alias("id"), price.alias("price"), F.lit(str(n)).alias("inventory_quantity"), F.concat(F.lit("Größe "), F.col("p_size").cast("string")).alias("title"),
        F.lit("2024-01-01T00:00:00+01:00").alias("created_at"), F.lit("kg").alias("weight_unit"))
    return p.select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("title"), F.lit("2023-12-31T00:00:00Z").alias("created_at"), F.lit("global").alias("published_scope"), F.lit("url").alias("image_src"),
        F.col("p_brand").alias("tags"), F.array(variant(1, _money(F.col("p_retailprice")).cast("string")), variant(2, F.lit("free"))).alias("variants"))


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("id"), F.lit("2020-05-06T07:08:09Z").alias("created_at"), F.lit("never").alias("updated_at"), _money(F.col("c_acctbal")).cast("string").alias("total_spent"),
        F.col("c_name").alias("first_name"), F.lit("x@y.example").alias("email"), F.lit("here").alias("default_address"), F.upper("c_mktsegment").alias("Segment Name"), F.lit("yes").alias("smsMarketingConsent"))


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as reviews with stars 1 to 5 by doc_id."""
    d = table(spark, sf_dir, "documents")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 365).cast("int"))
    at = F.date_format(day, "yyyy-MM-dd'T'00:00:00'Z'")
    return d.select(
        F.col("doc_id").cast("string").alias("id"), F.col("lang").alias("language"), F.lit("").alias("title"), "text", (F.col("doc_id") % 5 + 1).cast("int").alias("stars"), at.alias("created_at"),
        at.alias("experienced_at"), F.lit(None).cast("string").alias("updated_at"), F.lit("3").alias("number_of_likes"), F.lit("active").alias("status"), F.lit("true").alias("counts_towards_trust_score"),
        (F.col("doc_id") % 7).cast("string").alias("consumer_number_of_reviews"), F.lit("h").alias("links_href_1"), F.lit("b").alias("business_unit_id"), F.lit("r").alias("company_reply_text"))


# Closed classes of German words.
CLOSED = {"DET": ("der", "die", "das", "dem", "den", "des"), "CCONJ": ("und",), "ADP": ("auf", "aus", "in", "im", "mit", "von", "zu"), "PART": ("nicht",)}


def tagged_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentences of German documents as a tagged table: the tables hold no tags, so closed classes and endings give them. Lemmas of nouns are singular."""
    words = tagger.sentences(table(spark, sf_dir, "documents").filter("lang = 'de'").select("doc_id", "text"))

    def tag(word: Column) -> Column:
        w = F.lower(word)
        out = F.when(w.rlike("(ung|heit|keit)(en)?$"), "NOUN").when(w.rlike("(lich|isch)$"), "ADJ").otherwise("X")
        for name, closed in CLOSED.items():
            out = F.when(w.isin(*closed), name).otherwise(out)
        return out

    return words.withColumns({"tags": F.transform("words", tag), "lemmas": F.transform("words", lambda w: F.regexp_replace(F.lower(w), "(ung|heit|keit)en$", "$1"))})


def agents(spark: SparkSession) -> DataFrame:
    return spark.sql("SELECT * FROM VALUES ('1000000000001', 'agent_a'), ('1000000000002', 'agent_b') AS t(id, name)")


def groups(spark: SparkSession) -> DataFrame:
    return spark.sql("SELECT * FROM VALUES ('2000000000001', 'group_x'), ('2000000000002', 'group_y') AS t(id, name)")


def raw_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of conversations as support tickets."""
    c = table(spark, sf_dir, "conversations")
    k = F.col("conv_id")
    start = F.timestamp_seconds(F.lit(1704067200) + k * 60)
    lead = F.element_at(F.array(F.lit("#"), F.lit(""), F.lit("12000000 siehe #"), F.concat(F.lit("#12000000 oder "))), (k % 4 + 1).cast("int"))
    ids = lambda n: F.when(k % n == 0, F.array(F.lit(1000000000001), F.lit(1000000000009))).when(k % n == 1, F.array().cast("array<bigint>"))
    return c.select(
        k.alias("id"), _at(start).alias("created_at"), _at(F.timestamp_seconds(F.unix_seconds(start) + F.col("turn") * 90)).alias("updated_at"), F.lit(1704067200).cast("long").alias("generated_timestamp"),
        F.lit("Betreff").alias("subject"), F.lit("Betreff").alias("raw_subject"), F.concat(F.lit("Frage zu "), lead, (F.lit(12100000) + k).cast("string")).alias("description"),
        F.when(F.col("role") == "user", "OPEN").when(F.col("role") == "assistant", "Closed").otherwise("new").alias("status"), F.lit("HIGH").alias("priority"), F.lit(5).cast("long").alias("requester_id"),
        F.when(k % 3 == 0, F.lit(1000000000001)).when(k % 3 == 1, F.lit(1000000000003)).alias("assignee_id"), F.lit(2000000000001).alias("group_id"),
        ids(2).alias("collaborator_ids"), ids(3).alias("follower_ids"), F.array().cast("array<bigint>").alias("email_cc_ids"), F.array().cast("array<bigint>").alias("followup_ids"), F.array(F.lit("T")).alias("tags"),
        F.array(F.struct(F.lit(7).cast("long").alias("id"), F.lit("feld").alias("value"))).alias("custom_fields"), F.lit(1).cast("long").alias("custom_status_id"), F.lit("agent").alias("support_type"),
        F.lit(True).alias("allow_attachments"), F.lit(False).alias("from_messaging_channel"), F.upper("role").alias("via_channel"), F.lit(None).cast("string").alias("via_source_rel"), F.lit("u").alias("url"))


def raw_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of conversations as a CSV export, all text, with exact duplicates."""
    c = table(spark, sf_dir, "conversations")
    k = F.col("conv_id")
    gone = ("organization_id", "problem_id", "brand_id", "due_at", "satisfaction_score", "satisfaction_reason", "inbound_sharing_agreement", "outbound_sharing_agreement", "type", "priority", "brand", "form",
            "custom_status_id", "external_id")
    at = _at(F.timestamp_seconds(F.lit(1704067200) + k * 60))
    return c.select(
        k.cast("string").alias("id"), F.when(k % 2 == 0, "10000000000024").otherwise("77").alias("assignee_id"), F.when(k % 3 == 0, "2000000000002").otherwise("20000000000021").alias("group_id"),
        at.alias("created_at"), at.alias("updated_at"), F.lit(" ").alias("assigned_at"), F.lit(None).cast("string").alias("initially_assigned_at"), F.lit("bald").alias("requester_updated_at"), at.alias("solved_at"),
        *[F.lit("x").alias(g) for g in gone])


def entrants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with lots by their amount, some with none."""
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").cast("string").alias("id"), F.lit("x@y.example").alias("email"), F.col("o_orderpriority").alias("first_name"), F.lit("").alias("last_name"),
                    F.floor(F.greatest(F.col("o_totalprice"), F.lit(0.0)) / 10000).cast("long").alias("amount_lose"))
