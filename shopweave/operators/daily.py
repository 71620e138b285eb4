"""Daily profit: new customers, item and order sums, refunds, ad spend, and the margin cascade."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopweave.session import require

#: Money is summed exactly, so that results do not depend on the order of rows.
MONEY = "decimal(18,4)"


def money_sum(value: Column) -> Column:
    """Exact sum, 0 for nothing."""
    return F.coalesce(F.sum(value.cast(MONEY)), F.lit(0))


def counted(items: DataFrame, exclude_cancelled: bool) -> DataFrame:
    """The items that count."""
    return items.filter(~F.coalesce("cancellation_status", F.lit(False))) if exclude_cancelled else items


def _first_orders(items: DataFrame) -> DataFrame:
    """Per customer c, the place of the first order; repeated item rows change nothing, so they need not be made distinct."""
    return items.groupBy(F.col("customer_id").alias("c")).agg(F.min(place()).alias("first"))


def place() -> Column:
    """What orders go by."""
    return F.struct(F.col("created_at").isNull().alias("late"), "created_at", "order_id")


def new_customer_flag(items: DataFrame, exclude_cancelled: bool = False) -> DataFrame:
    """order_id, customer_id, created_at, is_nc: true for each customer's first order of all time.

    Orders go by created_at (nulls last), then order_id; customers without an id count as
    one. Cancelled orders count unless exclude_cancelled. The first orders are found by an
    aggregate and joined back, so a customer with very many orders is no bottleneck.
    """
    require(items, "order_id", "customer_id", "created_at")
    some = counted(items, exclude_cancelled)
    orders = some.select("order_id", "customer_id", "created_at").distinct()
    return orders.join(_first_orders(some), F.col("customer_id").eqNullSafe(F.col("c"))).select(
        "order_id", "customer_id", "created_at", place().eqNullSafe(F.col("first")).alias("is_nc"))


def order_date_violations(items: DataFrame) -> DataFrame:
    """Orders whose items do not agree on created_at, which all daily tables rely on: order_id, first, last, dates (how many differ; a missing one counts). Counts are aggregated before they are shuffled."""
    require(items, "order_id", "created_at")
    per = items.groupBy("order_id", "created_at").agg(F.count("*").alias("items"))
    return per.groupBy("order_id").agg(F.min("created_at").alias("first"), F.max("created_at").alias("last"), F.count("*").alias("dates")).filter("dates > 1")


def flagged_items(items: DataFrame, exclude_cancelled: bool = False) -> DataFrame:
    """items with their day and is_nc. An order_id must have one created_at (see order_date_violations); with two it would be an order of each day."""
    some = counted(items, exclude_cancelled)
    joined = some.join(_first_orders(some), F.col("customer_id").eqNullSafe(F.col("c")))
    return joined.withColumns({"date": F.to_date("created_at"), "is_nc": place().eqNullSafe(F.col("first"))}).drop("c", "first")


ORDER_COSTS = ("total_shipping_cost", "total_packaging", "total_payment_fees")


def daily_sales(flagged: DataFrame) -> DataFrame:
    """Item and order sums per day of items with their day and flag, from one pass: first one row per order, day, flag and costs, with the sums of its items."""
    per = flagged.groupBy("order_id", "date", "is_nc", *ORDER_COSTS).agg(*[money_sum(F.col(c)).alias(c) for c in ("item_gross_revenue", "item_net_revenue", "total_cogs", "quantity")])
    return _doubles(per.groupBy("date").agg(*_item_sums(), *_order_sums()))


def _item_sums() -> list[Column]:
    gross, net = money_sum(F.col("item_gross_revenue")), money_sum(F.col("item_net_revenue"))
    return [
        gross.alias("gross_revenue"), net.alias("net_revenue_items"), money_sum(F.col("total_cogs")).alias("product_costs"), money_sum(F.col("quantity")).alias("gross_quantity"),
        money_sum(F.when(F.col("is_nc"), F.col("item_gross_revenue"))).alias("nc_gross_revenue"), (gross - net).alias("taxes")]


def _order_sums() -> list[Column]:
    return [
        (money_sum(F.col("total_shipping_cost")) + money_sum(F.col("total_packaging"))).alias("fulfillment_costs"), money_sum(F.col("total_payment_fees")).alias("transaction_costs"),
        (F.count_distinct("order_id") + F.max(F.col("order_id").isNull().cast("long"))).alias("gross_orders"), F.sum(F.col("is_nc").cast("long")).alias("nc_gross_orders")]


def daily_items(items: DataFrame, exclude_cancelled: bool = False) -> DataFrame:
    """Per day: gross and net item revenue, product costs, quantity, gross revenue of new customers, taxes."""
    require(items, "item_gross_revenue", "item_net_revenue", "total_cogs", "quantity")
    return _doubles(flagged_items(items, exclude_cancelled).groupBy("date").agg(*_item_sums()))


def daily_orders(items: DataFrame, exclude_cancelled: bool = False) -> DataFrame:
    """Per day: fulfilment costs, payment fees, orders, orders of new customers. Order amounts stand on each item row and count once."""
    require(items, *ORDER_COSTS)
    once = flagged_items(items, exclude_cancelled).select("order_id", "date", "is_nc", *ORDER_COSTS).distinct()
    return _doubles(once.groupBy("date").agg(*_order_sums()))


def daily_refunds(returns: DataFrame, basis: str = "refund_date") -> DataFrame:
    """Refunds per day of completion ('refund_date') or of the original order ('conversion_date'); returns and mixed ones only, days unknown go."""
    days = {"refund_date": "order_completed_date", "conversion_date": "shopify_created_at"}
    if basis not in days:
        raise ValueError(f"unknown refund date basis: {basis}")
    paid = returns.filter((F.col("status") == "refunded") & F.col("type").isin("return", "mix")).withColumn("date", F.to_date(days[basis]))
    return _doubles(paid.filter("date IS NOT NULL").groupBy("date").agg(money_sum(F.col("refund_amount")).alias("refunds")))


def daily_spend(ads: DataFrame) -> DataFrame:
    """Per day: spend, impressions, clicks."""
    require(ads, "date_start", "spend", "impressions", "clicks")
    return _doubles(ads.groupBy(F.to_date("date_start").alias("date")).agg(
        money_sum(F.col("spend")).alias("channel_spend"), F.coalesce(F.sum(F.col("impressions").cast("long")), F.lit(0)).alias("channel_impressions"),
        F.coalesce(F.sum(F.col("clicks").cast("long")), F.lit(0)).alias("channel_clicks")))


def _doubles(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f.name).cast("double").alias(f.name) if f.dataType.typeName() == "decimal" else F.col(f.name) for f in df.schema.fields])


SALES = ("order_id", "customer_id", "created_at", "item_gross_revenue", "item_net_revenue", "total_cogs", "quantity", *ORDER_COSTS)


def daily_business(items: DataFrame, returns: DataFrame, ads: DataFrame, basis: str = "refund_date", exclude_cancelled: bool = False) -> DataFrame:
    """Profit per day, sorted by day: revenue less taxes and refunds, then product costs (cm1), transaction and fulfilment (cm2), and ad spend (cm3).

    Item and order sums come from one pass over the items.
    """
    require(items, *SALES)
    return margins(daily_sales(flagged_items(items, exclude_cancelled)), daily_refunds(returns, basis), daily_spend(ads))


def margins(sales: DataFrame, refunds: DataFrame, spend: DataFrame) -> DataFrame:
    """The margin cascade over daily sales, refunds and spend. Each has one row a day, so a union summed by day equals their full outer joins, and unknown days fall together without more ado."""
    money = ("gross_revenue", "taxes", "refunds", "product_costs", "transaction_costs", "fulfillment_costs", "channel_spend", "nc_gross_revenue", "gross_quantity")
    counts = ("channel_impressions", "channel_clicks", "gross_orders", "nc_gross_orders")
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [sales, refunds, spend])
    day = both.groupBy("date").agg(*[money_sum(F.col(c)).alias(c) for c in money], *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts])
    day = day.withColumn("net_revenue", F.col("gross_revenue") - F.col("taxes") - F.col("refunds"))
    day = day.withColumn("cm1", F.col("net_revenue") - F.col("product_costs"))
    day = day.withColumn("cm2", F.col("cm1") - F.col("transaction_costs") - F.col("fulfillment_costs"))
    day = day.withColumn("cm3", F.col("cm2") - F.col("channel_spend"))
    return _doubles(day).select(
        "date", "gross_revenue", "taxes", "refunds", "net_revenue", "product_costs", "cm1", "transaction_costs", "fulfillment_costs", "cm2",
        "channel_spend", "cm3", "channel_impressions", "channel_clicks", "gross_orders", "nc_gross_orders", "nc_gross_revenue", "gross_quantity").orderBy("date")
