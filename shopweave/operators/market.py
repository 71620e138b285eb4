"""The weekly trading view: prices of a week, volume colours, moving averages, relative strength.

Windows run over whole weeks, of which there are some fifty a year; sums inside them are
exact decimals, so thresholds and crossings do not depend on rounding.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from .daily import MONEY

FAST, SLOW, VOLUME_WEEKS, RSI_WEEKS = 4, 12, 4, 14


def _weeks() -> WindowSpec:
    return Window.orderBy("week_start")


def _rolled(value: Column, k: int) -> Column:
    """Exact sum of the last k weeks; null unless all k are there."""
    w = _weeks().rowsBetween(-(k - 1), 0)
    return F.when(F.count(value).over(w) == k, F.sum(value).over(w))


def _exact(name: str) -> Column:
    return F.col(name).cast(MONEY)


def weekly_ohlc(items: DataFrame, returns: DataFrame) -> DataFrame:
    """week_start (Monday), open, high, low, close, volume of daily revenue from paid orders without a return of type 'return'.

    close is the last day's revenue, open the week before's close (the first week's: its low).
    Weeks without sales do not appear.
    """
    returned = returns.filter(F.col("type") == "return").select(F.col("shopify_order_id").alias("order_id")).distinct()
    sold = items.filter(F.col("financial_status").isin("paid", "partially_paid")).select("order_id", "created_at", "item_gross_revenue", "quantity")
    sold = sold.join(returned, "order_id", "left_anti")
    daily = sold.groupBy(F.to_date("created_at").alias("date")).agg(
        F.coalesce(F.sum(_exact("item_gross_revenue")), F.lit(0)).alias("revenue"), F.coalesce(F.sum(_exact("quantity")), F.lit(0)).alias("quantity"))
    weekly = daily.groupBy(F.to_date(F.date_trunc("week", "date")).alias("week_start")).agg(
        F.max("revenue").alias("high"), F.min("revenue").alias("low"), F.max_by("revenue", "date").alias("close"), F.sum("quantity").alias("volume"))
    opened = F.coalesce(F.lag("close").over(_weeks()), F.first("low").over(_weeks()))
    return weekly.select("week_start", *[c.cast("double").alias(n) for n, c in (("open", opened), ("high", F.col("high")), ("low", F.col("low")), ("close", F.col("close")), ("volume", F.col("volume")))])


def volume_spread_color(weekly: DataFrame) -> DataFrame:
    """weekly with bullish (close at or above open), vol_sma4 and the colour of the week's volume against it."""
    rolled = _rolled(_exact("volume"), VOLUME_WEEKS)
    out = weekly.withColumns({"bullish": F.col("close") >= F.col("open"), "__sum": rolled})
    volume, up = _exact("volume") * 4 * VOLUME_WEEKS, F.col("bullish")  # four times, so that quarters are whole numbers
    color = (
        F.when(up & (volume >= 8 * F.col("__sum")), "green").when(up & (volume >= 6 * F.col("__sum")), "turquoise").when(up, "yellow")
        .when(~up & (volume <= 2 * F.col("__sum")), "red").when(~up & (volume <= 3 * F.col("__sum")), "pink").otherwise("grey"))
    return out.withColumns({"vol_sma4": F.col("__sum").cast("double") / VOLUME_WEEKS, "fill_color": color}).drop("__sum")


def sma_crossovers(weekly: DataFrame) -> DataFrame:
    """weekly with the 4- and 12-week means of close and the weeks in which one line crosses the other."""
    fast, slow = _rolled(_exact("close"), FAST), _rolled(_exact("close"), SLOW)
    out = weekly.withColumns({"__fast": fast * (SLOW // FAST), "__slow": slow, "sma_fast": fast.cast("double") / FAST, "sma_slow": slow.cast("double") / SLOW})
    was = lambda c: F.lag(c).over(_weeks())
    out = out.withColumns({
        "cross_up": (was("__fast") < was("__slow")) & (F.col("__fast") >= F.col("__slow")),
        "cross_dn": (was("__fast") > was("__slow")) & (F.col("__fast") <= F.col("__slow")),
    }).drop("__fast", "__slow")
    crossed = F.col("cross_up").isNotNull() & F.col("cross_dn").isNotNull() & (F.col("cross_up") | F.col("cross_dn"))
    return out.withColumn("is_crossover", F.coalesce(crossed, F.lit(False)))


def rsi(weekly: DataFrame) -> DataFrame:
    """weekly with change, gain, loss, their 14-week means, rs and rsi; the first rsi is in week 15."""
    change = _exact("close") - F.lag(_exact("close")).over(_weeks())
    out = weekly.withColumn("__change", change)
    out = out.withColumns({"__gain": F.when(F.col("__change").isNotNull(), F.greatest("__change", F.lit(0))), "__loss": F.when(F.col("__change").isNotNull(), F.greatest(-F.col("__change"), F.lit(0)))})
    out = out.withColumns({
        "change": F.col("__change").cast("double"), "gain": F.col("__gain").cast("double"), "loss": F.col("__loss").cast("double"),
        "avg_gain": _rolled(F.col("__gain"), RSI_WEEKS).cast("double") / RSI_WEEKS, "avg_loss": _rolled(F.col("__loss"), RSI_WEEKS).cast("double") / RSI_WEEKS,
    }).drop("__change", "__gain", "__loss")
    out = out.withColumn("rs", F.col("avg_gain") / F.when(F.col("avg_loss") == 0, F.lit(1e-10)).otherwise(F.col("avg_loss")))
    return out.withColumn("rsi", 100 - 100 / (1 + F.col("rs")))


def weekly_market_view(items: DataFrame, returns: DataFrame) -> DataFrame:
    """Everything the weekly chart is drawn from, with the label of each week, by week."""
    out = rsi(sma_crossovers(volume_spread_color(weekly_ohlc(items, returns))))
    label = F.format_string(
        "<b>Woche: %s</b><br>Open: %.2f €<br>High: %.2f €<br>Low: %.2f €<br>Close: %.2f €<br>Volumen: %d Stück",
        F.date_format("week_start", "dd.MM.yyyy"), *[F.round(F.col(c).cast(MONEY), 2).cast("double") for c in ("open", "high", "low", "close")], F.col("volume").cast("long"))
    return out.withColumn("hover_text", label).orderBy("week_start")
