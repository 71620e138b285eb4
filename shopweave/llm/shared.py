"""Helpers that several corpus operators share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopweave.session import new_path


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Write df as a table in the shared folder and read it again: cuts lineage, and a lost executor costs only a reread."""
    spark = df.sparkSession
    df.write.parquet(path := new_path(spark, tag))
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete stored tables that nothing will read again, because all that was made of them is stored itself."""
    for table in tables:
        session = table.sparkSession
        path = session._jvm.org.apache.hadoop.fs.Path(table.stored_at)
        path.getFileSystem(session._jsc.hadoopConfiguration()).delete(path, True)


def uniform(*cols: Column, seed: int = 0) -> Column:
    """A number in [0, 1) that depends on the values only, never on partitions or reruns."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *cols), 11)
    return bits.cast("double") / F.lit(float(1 << 53))


def hashed_share(rows: DataFrame, key: str, there: int, wanted: int) -> DataFrame:
    """All rows if there are at most wanted of them, else about 0.95 * wanted by the hash of key: no sort, no gathering in one task, the same rows on every run."""
    if there <= wanted:
        return rows
    return rows.filter(uniform(F.col(key)) < 0.95 * wanted / there)


def most_frequent(words: DataFrame, most: int) -> DataFrame:
    """At most `most` of the rows of words, all whose count `whole` is above some value: found from a histogram, not by sorting in one task."""
    step = F.floor(F.log2("whole") * 64).cast("int")
    left, least = most, None
    for r in words.groupBy(step.alias("step")).agg(F.count("*").alias("n")).orderBy(F.desc("step")).collect():
        left -= r["n"]
        if left < 0:
            break
        least = r["step"]
    return words.filter(step >= least) if least is not None else words.limit(0)


#: Bits of the table by which rows are parted (2 MB).
PARTED_BITS = 24


def parted(rows: DataFrame, key: Column, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows whose key may be among keys, a stored table of one column, and the rows whose key certainly is not.

    This is told by a bit for each hash, in a table of fixed size that is broadcast, so where few rows
    are concerned the others need not be shuffled to find that out. The more keys there are, the more rows come into the first part.
    """
    slot = lambda k: F.pmod(F.xxhash64(k), F.lit(1 << PARTED_BITS))
    bit = F.expr("shiftleft(1L, cast(__slot & 63 as int))")
    word = F.shiftright("__slot", 6).alias("__word")
    table = keys.select(slot(F.col(keys.columns[0])).alias("__slot")).groupBy(word).agg(F.bit_or(bit).alias("__bits"))
    marked = rows.withColumn("__slot", slot(key)).withColumn("__word", word).join(F.broadcast(table), "__word", "left")
    hit = F.coalesce(F.col("__bits").bitwiseAND(bit) != 0, F.lit(False))
    return marked.filter(hit).select(*rows.columns), marked.filter(~hit).select(*rows.columns)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


class Remembered(dict):
    """Results of make(key) in two generations of at most size keys: a full one becomes the old one, so frequent keys survive."""

    def __init__(self, make: Callable[[Any], Any], size: int):
        super().__init__()
        self.make, self.size, self.old = make, size, {}

    def __missing__(self, key: Any) -> Any:
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        got = self.old.get(key)
        if got is None:
            got = self.make(key)
        self[key] = got
        return got


def give_back() -> None:
    """Return memory that is free but still kept by Arrow and the C library to the system, so that what a worker held for one stage is not added to what it needs for the next."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # the GNU C library has it
        trim(0)


_held: dict[Any, Any] = {}


def held(key: Any, make: Callable[[], Any]) -> Any:
    """make()'s result, kept in this Python worker from task to task; what the worker kept under another key is dropped first."""
    if key not in _held:
        _held.clear()
        give_back()
        _held[key] = make()
        give_back()  # what making it took
    return _held[key]
