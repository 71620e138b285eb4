"""A prize draw with weights, reproducible from a seed and independent of partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Kinds of prizes and how many there are of each.
PRIZES = [
    ("Reisegutschein 2.500 €", 10),
    ("Erstattete Bestellung", 100),
    ("Gratis Produkt neue Kollektion", 100),
    ("50 € Gutschein", 300),
    ("Luxus-Wellness-Wochenende (Wellcard 500 €)", 10),
    ("Spa- & Beauty-Tag (Wellcard 300 €)", 10),
    ("Shopping-Day 1.000 €", 5),
]


def uniform(seed: str, key: Column) -> Column:
    """A number in (0, 1) from an md5 of seed and key."""
    digits = F.conv(F.substring(F.md5(F.concat(F.lit(seed), key.cast("string")).cast("binary")), 1, 12), 16, 10).cast("double")
    return (digits + 0.5) / F.lit(float(16**12))


def weighted_draw(df: DataFrame, weight: str = "amount_lose", prizes: list[tuple[str, int]] = PRIZES, seed: str = "1", key: str = "id") -> DataFrame:
    """Winners among rows of positive weight, one per prize, drawn without replacement with chances by weight, and their prizes.

    The least of -ln(u) / weight win, which is the same as drawing one after the other. Ties
    go to the smaller key. Raises ValueError if fewer rows than prizes can win. Winners are as
    many as prizes, whatever the size of df.
    """
    n = sum(c for _, c in prizes)
    can = df.filter(F.col(weight) > 0)
    winners = can.withColumn("__key", -F.log(uniform(f"{seed}:draw:", F.col(key))) / F.col(weight)).orderBy("__key", key).limit(n)
    if winners.count() < n:
        raise ValueError(f"fewer than {n} rows can win")
    bounds, start = [], 0
    for name, c in prizes:
        bounds.append((name, start, start + c))
        start += c
    shuffled = winners.withColumn("__rank", F.row_number().over(Window.orderBy(uniform(f"{seed}:prize:", F.col(key)), key)) - 1)
    prize = F.coalesce(*[F.when((F.col("__rank") >= a) & (F.col("__rank") < b), F.lit(name)) for name, a, b in bounds])
    return shuffled.withColumn("prize", prize).drop("__key", "__rank")
