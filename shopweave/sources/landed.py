"""Landed API pages, files in a declared format, and warehouse tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopweave.operators.clean import clean_master


def flatten_struct(df: DataFrame, sep: str = "_") -> DataFrame:
    """Fields of structs, at any depth, as columns of their own, names joined by sep; arrays stay as they are."""

    def leaves(at: Column, name: str, kind: T.DataType) -> list[Column]:
        if not isinstance(kind, T.StructType):
            return [at.alias(name)]
        return [c for f in kind.fields for c in leaves(at.getField(f.name), f"{name}{sep}{f.name}", f.dataType)]

    return df.select(*[c for f in df.schema.fields for c in leaves(F.col(f"`{f.name}`"), f.name, f.dataType)])


def read_landed_pages(spark: SparkSession, path: str, records: str, schema: T.StructType | str, multi_line: bool = True) -> DataFrame:
    """One row per record of all JSON pages below path, objects flattened to columns.

    records is the dotted path of the record array in a page, schema the page's schema.
    Pages whose array is missing or empty give no rows; fields that a page lacks are null.
    path should be one landed batch: files of earlier runs count as new data otherwise.
    """
    pages = spark.read.schema(schema).json(path, multiLine=multi_line)
    return flatten_struct(pages.select(F.explode(F.col(records)).alias("r")).select("r.*"))


def stack_by_name(*dfs: DataFrame) -> DataFrame:
    """Rows of all tables, columns matched by name, missing ones null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def read_clean(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """A CSV ('csv', NA for null) or Parquet ('parquet') file, cleaned by clean_master; other kinds raise ValueError."""
    if kind == "csv":
        df = spark.read.csv(path, header=True, inferSchema=True, nullValue="NA")
    elif kind == "parquet":
        df = spark.read.parquet(path)
    else:
        raise ValueError(f"unknown file kind: {kind}")
    return clean_master(df)


def publish_table(df: DataFrame, target: str, mode: str = "append", fmt: str = "parquet") -> None:
    """Load df into a warehouse table, made if missing: 'append' adds its rows, 'truncate' puts them in place of all others."""
    if mode not in ("append", "truncate"):
        raise ValueError(f"unknown mode: {mode}")
    df.write.format(fmt).mode("append" if mode == "append" else "overwrite").saveAsTable(target)
