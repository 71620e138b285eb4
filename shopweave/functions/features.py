"""Scalar and array features, all as Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Payment sub-types and ad creative types, first hit wins.
PAYMENT_RULES = [
    ("wallet", "paypal wallet"),
    ("30 tagen", "rechnung (30 tage)"),
    ("3 plazos|3 rate|pay in 3", "ratenzahlung (3 raten)"),
    ("4x|pay in 4|4 months", "ratenzahlung (4 raten)"),
    ("ratenzahlung", "ratenzahlung (allgemein)"),
]
CREATIVE_RULES = [
    ("video|reel|tiktok|mp4", "video"),
    ("image|static|bild|foto|jpg|png", "image"),
    ("carousel|karussell", "carousel"),
]
#: Fixed value: this order number stands for none.
PLACEHOLDER = "12000000"
#: Most rows of a lookup table that go into an expression.
LOOKUP_ROWS = 1_000


def parse_utc(text: Column) -> Column:
    """Text as a UTC timestamp; blank or bad text is null. Upper case first: 't' and 'z' are not understood."""
    return F.nullif(F.trim(F.upper(text)), F.lit("")).try_cast("timestamp")


def to_number(value: Column) -> Column:
    """Text as a double; bad text is null."""
    return value.try_cast("double")


def classify(text: Column, rules: list[tuple[str, str]], default: Column) -> Column:
    """Label of the first rule whose pattern is found in text, else default; null text gets the default."""
    out = default
    for pattern, label in reversed(rules):
        out = F.when(text.rlike(pattern), F.lit(label)).otherwise(out)
    return out


def last_address_part(address: Column) -> Column:
    """What follows the last comma, trimmed, in lower case."""
    return F.lower(F.trim(F.element_at(F.split(address, r",\s*"), -1)))


def extract_order_number(*texts: Column) -> Column:
    """The order number in the texts taken together: left-most of 8 digits right after '#' or standing free, else the first '#' and 8 digits."""
    whole = F.concat_ws(" ", *texts)
    found = lambda pattern, group: F.nullif(F.nullif(F.regexp_extract(whole, pattern, group), F.lit("")), F.lit(PLACEHOLDER))
    return F.coalesce(found(r"(?<=#)\d{8}|\b\d{8}\b", 0), found(r"#(\d{8})", 1))


def lookup(dim: DataFrame, key: str = "id", value: str = "name") -> Column:
    """A lookup table of at most LOOKUP_ROWS rows as a map of text to text, in order of its keys; larger ones raise ValueError."""
    rows = dim.select(F.col(key).cast("string").alias("k"), F.col(value).cast("string").alias("v")).dropna().groupBy("k").agg(F.min("v").alias("v")).limit(LOOKUP_ROWS + 1).collect()
    if len(rows) > LOOKUP_ROWS:
        raise ValueError(f"the lookup table has more than {LOOKUP_ROWS} rows: join it instead")
    pairs = [F.lit(x) for r in sorted(rows) for x in r]
    return F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")


def map_ids(ids: Column, names: Column, mode: str) -> Column:
    """Names for ids, unchanged where unknown, null where null: 'exact' looks ids up, 'prefix' takes the first known id that the value starts with."""
    text = ids.cast("string")
    if mode == "exact":
        return F.coalesce(F.try_element_at(names, text), text)
    if mode == "prefix":
        hit = F.get(F.filter(F.map_entries(names), lambda e: text.startswith(e["key"])), F.lit(0))
        return F.coalesce(hit["value"], text)
    raise ValueError(f"unknown mode: {mode}")


def map_id_array(ids: Column, names: Column, mode: str) -> Column:
    """map_ids for each element; null, empty or all-null arrays become one null."""
    mapped = F.transform(ids.cast("array<string>"), lambda x: map_ids(x, names, mode))
    return F.when(F.size(F.array_compact(F.coalesce(mapped, F.array().cast("array<string>")))) > 0, mapped).otherwise(F.array(F.lit(None).cast("string")))


def payment_method(gateways: Column) -> Column:
    """All gateways joined by ', '; none is the empty text."""
    return F.coalesce(F.array_join(gateways, ", ", "NA"), F.lit(""))


def discount_code(codes: Column) -> Column:
    """All codes joined by ', '; none is null."""
    return F.when(F.size(codes) > 0, F.array_join(F.transform(codes, lambda c: c["code"]), ", ", "NA"))


def first_refund(refunds: Column) -> Column:
    """The earliest refund time, null if none."""
    return F.array_min(F.transform(refunds, lambda r: parse_utc(r["created_at"])))


def duration_minutes(start: Column, end: Column) -> Column:
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(6e7)


def duration_days(start: Column, end: Column) -> Column:
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(8.64e10)


def widen_array(df: DataFrame, column: str, n: int | None = None) -> DataFrame:
    """The first n elements of an array as column_1 .. column_n in its place; without n, as many as the longest array has (one more pass)."""
    if n is None:
        n = df.agg(F.max(F.size(column))).first()[0] or 0
    wide = [F.get(F.col(column), F.lit(i)).alias(f"{column}_{i + 1}") for i in range(max(n, 0))]
    return df.select(*[x for c in df.columns for x in (wide if c == column else [F.col(f"`{c}`")])])
