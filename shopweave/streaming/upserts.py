"""The daily upsert as a stream: landed files come in, each micro-batch is merged into the master."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shopweave.plans.refresh import upsert_into
from shopweave.session import new_path


def stream_upserts(spark: SparkSession, landed: str, schema: T.StructType | str, master: str, checkpoint: str, keys: list[str],
                   clean: Callable[[DataFrame], DataFrame] = lambda df: df, updated: str | None = None, by: str | None = None) -> StreamingQuery:
    """Merge the Parquet files that are landed so far into the master and stop; the next call goes on with later ones.

    by names the column by whose day the master is stored; then a batch reads and writes only the days that it changes.
    A batch that is run again after a failure changes nothing, because an upsert of the same
    rows gives the same master.
    """

    def merge(batch: DataFrame, _: int) -> None:
        new = clean(batch)
        new.write.parquet(staged := new_path(spark, "batch"))
        upsert_into(spark, master, spark.read.schema(new.schema).parquet(staged), keys, updated, by)

    stream = spark.readStream.schema(schema).parquet(landed)
    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
