"""Landed pages that are read once: a ledger of files, records of good pages, and a quarantine for the rest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopweave.session import children
from shopweave.sources.landed import flatten_struct

CORRUPT = "_corrupt_record"
GOOD, REPEATED, MALFORMED, NO_RECORDS = "good", "repeated", "malformed", "no_records"


def ingest_pages(spark: SparkSession, landed: str, store: str, records: str, schema: T.StructType | str) -> None:
    """Take in the JSON pages (one a file) that landed holds and store has not seen.

    Which files were seen is kept by the file stream (store/seen), so files of earlier runs are
    not opened again (a file that is written over keeps its first reading). A page whose bytes
    came before, under any name, is 'repeated' and gives no records; of several in one run the
    smallest path counts. A page that is no JSON object of the schema, is blank or has a value
    of another type is 'malformed', one without the array named by the dotted path records is
    'no_records'; both lie whole in the quarantine. An empty array is good. Files of no bytes
    are passed over by Spark's scans and appear nowhere. Fields beyond the schema are left out,
    missing ones are null.

    Each run writes folders of its own, the ledger's last; a run that broke off is written
    anew under the same number, and readers see only runs that the ledger holds.
    """
    shape = T.StructType(list((T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields) + [T.StructField(CORRUPT, T.StringType())])
    pages = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary").option("maxFileAge", "36500d").option("recursiveFileLookup", "true").load(landed)

    def take(batch: DataFrame, run: int) -> None:
        judged = _judge(batch.select("path", "content"), _digests(batch.sparkSession, store, run), records, shape).persist()
        good = judged.filter(F.col("status") == GOOD)
        flatten_struct(good.select(F.explode(f"page.{records}").alias("r")).select("r.*")).write.mode("overwrite").parquet(f"{store}/records/run={run}")
        bad = judged.filter(F.col("status").isin(MALFORMED, NO_RECORDS))
        bad.select("path", F.col("status").alias("reason"), "text").write.mode("overwrite").parquet(f"{store}/quarantine/run={run}")
        ledger = judged.select("path", "digest", "status", F.when(F.col("status") == GOOD, F.size(f"page.{records}")).otherwise(0).cast("bigint").alias("n_records"))
        ledger.write.mode("overwrite").parquet(f"{store}/ledger/run={run}")
        judged.unpersist()

    pages.writeStream.foreachBatch(take).option("checkpointLocation", f"{store}/seen").trigger(availableNow=True).start().awaitTermination()


def _digests(spark: SparkSession, store: str, run: int) -> DataFrame:
    """Digests of the pages of earlier runs."""
    if run == 0:
        return spark.createDataFrame([], "digest string")
    return read_ledger(spark, store).filter(F.col("run") < run).select("digest").distinct()


def _judge(files: DataFrame, known: DataFrame, records: str, shape: T.StructType) -> DataFrame:
    """path, digest, text, page and status of files(path, content)."""
    read = files.select("path", F.sha2("content", 256).alias("digest"), F.col("content").cast("string").alias("text"))
    # Only digests and paths meet here: the first path of each digest, of those not known.
    first = read.groupBy("digest").agg(F.min("path").alias("path")).join(known, "digest", "left_anti").withColumn("fresh", F.lit(True))
    parsed = read.join(first, ["digest", "path"], "left").withColumn("page", F.from_json("text", shape, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}))
    status = (
        F.when(F.col("fresh").isNull(), REPEATED).when(F.col("page").isNull() | F.col(f"page.{CORRUPT}").isNotNull() | (F.trim("text") == ""), MALFORMED)
        .when(F.col(f"page.{records}").isNull(), NO_RECORDS).otherwise(GOOD))
    return parsed.withColumn("status", status)


def read_ledger(spark: SparkSession, store: str) -> DataFrame:
    """path, digest, status, n_records and run of every file taken in, a row a file."""
    return _finished(spark, store, "ledger")


def read_records(spark: SparkSession, store: str) -> DataFrame:
    """Records of all good pages, with their run; fields that a run lacks are null."""
    return _finished(spark, store, "records")


def read_quarantine(spark: SparkSession, store: str) -> DataFrame:
    """path, reason, text and run of the pages that gave no records."""
    return _finished(spark, store, "quarantine")


def _finished(spark: SparkSession, store: str, part: str) -> DataFrame:
    """A part's folders of finished runs, by name. A run begins after the one before it, so only the last may be unfinished."""
    runs = sorted((n for n in children(spark, f"{store}/ledger") if n.startswith("run=")), key=lambda n: int(n[4:]))
    if runs and "_SUCCESS" not in children(spark, f"{store}/ledger/{runs[-1]}"):
        runs.pop()
    if not runs:
        raise ValueError(f"no finished run in {store}")
    return spark.read.option("basePath", f"{store}/{part}").option("mergeSchema", "true").parquet(*[f"{store}/{part}/{n}" for n in runs])
