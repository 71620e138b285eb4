"""Session settings that every job of this package relies on."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: UTC makes day and week boundaries the same on every machine; AQE splits skewed
#: joins and sizes the shuffles; ANSI stays on, so bad casts need try_cast.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def get_spark(master: str | None = None, app: str = "shopweave", **conf: str) -> SparkSession:
    """A session with SETTINGS; master and further settings only where the caller gives them."""
    builder = SparkSession.builder.appName(app).config(map={**SETTINGS, **conf})
    return (builder.master(master) if master else builder).getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where that is unset and all runs on one machine (tests), one of our own; on a cluster that is an error."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="spark-shopweave-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def new_path(spark: SparkSession, tag: str) -> str:
    """A path below shared_dir that nothing has used yet."""
    return f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"


def _found(spark: SparkSession, path: str) -> tuple[object, object]:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder, in any store that Spark reads; none where there is no such folder."""
    store, at = _found(spark, path)
    return sorted(f.getPath().getName() for f in store.listStatus(at)) if store.exists(at) else []


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder with all that lies in it."""
    store, at = _found(spark, path)
    store.delete(at, True)


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """df by keys, in just as many partitions as the session gives to shuffles, for sorts and aggregates by these keys.

    Adaptive execution merges partitions up to 64 MB of compressed bytes; narrow rows of keys, dates and
    money are many times that in the sorts and hash tables of a task, so here it is kept from merging.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def require(df: DataFrame, *columns: str) -> None:
    """Raise ValueError naming the columns that df lacks."""
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"missing columns: {', '.join(missing)}")
