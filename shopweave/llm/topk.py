"""Exact top-k search by inner product: tiles of queries and shards, multiplied as matrices.

Each tile keeps the k best of each of its queries; lists are merged first by groups of
shards, then by query.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import stored

#: Largest sum that doubles add without rounding.
EXACT = float(1 << 53)
#: Groups that shards are dealt to before groups hold several, and query blocks on a side of the grid.
SPREAD, SIDE = 64, 64


def quantized(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component, x as double; null where the vector or a component is null or not finite."""
    x = lambda v: v.cast("double")
    bad = F.exists(vector, lambda v: v.isNull() | F.isnan(x(v)) | (F.abs(x(v)) == float("inf")))
    return F.when(vector.isNotNull() & ~F.coalesce(bad, F.lit(False)), F.transform(vector, lambda v: F.floor(x(v) * scale).cast("double")))


def _packed(rows: DataFrame, label: str, size: int) -> DataFrame:
    """rows(id, vector) of each partition packed into shards of equal dimension and at most size rows: label, dim, n, top, ids, matrix."""
    schema = f"{label} string, dim int, n int, top double, ids binary, matrix binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, made = TaskContext.get().partitionId(), 0
        open_: dict[int, list[tuple[int, np.ndarray]]] = {}

        def close(dim: int) -> pa.RecordBatch:
            nonlocal made
            held = sorted(open_.pop(dim), key=lambda r: r[0])
            matrix = np.array([v for _, v in held]).reshape(len(held), dim)
            ids = np.array([i for i, _ in held], dtype=np.int64)
            if len(np.unique(ids)) < len(ids):  # equal rows count once
                rows = np.concatenate([ids[:, None].view(np.float64), matrix + 0.0], axis=1)
                once = np.sort(np.unique(np.ascontiguousarray(rows).view(f"V{8 * (dim + 1)}").ravel(), return_index=True)[1])
                ids, matrix = ids[once], matrix[once]
            made += 1
            top = float(np.abs(matrix).max()) if matrix.size else 0.0
            return pa.RecordBatch.from_pylist([{label: f"{part}-{made}", "dim": dim, "n": len(ids), "top": top,
                                                "ids": ids.tobytes(), "matrix": matrix.tobytes()}],
                                              schema=pa.schema([(label, pa.string()), ("dim", pa.int32()), ("n", pa.int32()), ("top", pa.float64()), ("ids", pa.binary()), ("matrix", pa.binary())]))

        for batch in batches:
            flat = batch.column("vector")
            for k, i in enumerate(batch.column("id").to_pylist()):
                v = flat[k].values.to_numpy(zero_copy_only=False)
                group = open_.setdefault(len(v), [])
                group.append((i, v))
                if len(group) >= size:
                    yield close(len(v))
        for dim in list(open_):
            yield close(dim)

    return rows.mapInArrow(run, schema)


def _tile(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, m: np.ndarray, exact: bool, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query, row and score of the k best rows of each query, ties to the smaller id; ids come sorted."""
    scores = q @ m.T if exact else np.array([[sum(int(a) * int(b) for a, b in zip(x, y, strict=True)) for y in m] for x in q], dtype=object)
    own = q_ids[:, None] == ids[None, :]
    # an id that has several vectors can fill several places of a list with one score
    take = min(k * int(np.unique(ids, return_counts=True)[1].max()), len(ids))
    if exact:
        scores[own] = -np.inf
        # partial selection: nothing below the take-th best score can be among the best
        least = np.partition(scores, len(ids) - take, axis=1)[:, len(ids) - take]
        rows, cols = np.nonzero((scores >= least[:, None]) & ~own)
    else:
        rows, cols = np.nonzero(~own)
    found = scores[rows, cols]
    order = np.lexsort((ids[cols], -found.astype(np.int64), rows))
    rows, cols, found = rows[order], cols[order], found[order]
    new = np.concatenate([[True], (rows[1:] != rows[:-1]) | (ids[cols[1:]] != ids[cols[:-1]]) | (found[1:] != found[:-1])])[: len(rows)]
    rows, cols, found = rows[new], cols[new], found[new]
    place = np.arange(len(rows)) - np.searchsorted(rows, rows)
    keep = place < k
    return q_ids[rows[keep]], ids[cols[keep]], found[keep].astype(np.int64)


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector: str = "embedding", scale: int = 256,
          block: int = 1024, shard: int = 4096, fan_in: int = 16) -> DataFrame:
    """The k rows of highest integer inner product for each query row: query_id, rank (from 1), vec_id, score.

    is_query marks the query rows among vectors; every row but those of the query's own id is a
    candidate. Null vectors or ids, and vectors with null or non-finite components,
    take no part, nor do those whose squared length, quantized, reaches 2^63, whose scores might not fit into
    64 bits; vectors meet only others of their own length, and an empty vector
    scores 0. Sums are exact: in doubles while they stay below 2^53, else in Python's
    integers. Ties go to the smaller id. Equal rows count once; of a query id with several vectors the least one
    asks, and a candidate id with several vectors may be listed once per score.
    Blocks and shards bound a tile's memory. Groups of shards and sides of blocks meet in a grid: each shard goes to
    every side, each block to every group, and lists are merged group by group in a tree.
    """
    v = quantized(F.col(vector), scale)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("vector"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    rows = rows.filter("id IS NOT NULL AND vector IS NOT NULL").filter(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x) < float(1 << 63))
    asks = rows.filter("asks").groupBy("id").agg(F.min("vector").alias("vector"))
    counts = rows.agg(F.count("*").alias("n"), F.count(F.when(F.col("asks"), 1)).alias("q")).first()
    blocks, shards_ = max(1, math.ceil(counts["q"] / block)), max(1, math.ceil(counts["n"] / shard))
    groups, sides = max(min(shards_, SPREAD), math.ceil(shards_ / fan_in)), math.ceil(blocks / SIDE)
    queries = stored(_packed(asks.repartition(blocks, F.xxhash64("id")), "q_block", block), "topk-queries")
    deal = lambda name, n: F.pmod(F.xxhash64(name), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    shards = _packed(rows.select("id", "vector"), "shard", shard).withColumn("group", deal("shard", groups)).withColumn("side", every(sides))
    q = queries.select("q_block", "dim", F.col("top").alias("q_top"), F.col("ids").alias("q_ids"), F.col("matrix").alias("q_matrix")).withColumn("side", deal("q_block", sides)).withColumn("group", every(groups))
    pairs = shards.join(q.hint("shuffle_merge"), ["dim", "group", "side"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                dim = r["dim"]
                get = lambda ids, m, d=dim: ((i := np.frombuffer(ids, dtype=np.int64)), np.frombuffer(m, dtype=np.float64).reshape(len(i), d))
                exact = r["q_top"] * r["top"] * max(dim, 1) < EXACT
                a, b, s = _tile(*get(r["q_ids"], r["q_matrix"]), *get(r["ids"], r["matrix"]), exact, k)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(s), pa.array([r["group"]] * len(a), pa.int32())], names=["query_id", "vec_id", "score", "group"])

    lists = pairs.mapInArrow(run, "query_id bigint, vec_id bigint, score bigint, group int")
    best = (F.col("score").desc(), F.col("vec_id"))

    def merged(df: DataFrame, *by: Column) -> DataFrame:
        return df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*best))).filter(F.col("rank") <= k)

    while groups > fan_in:
        groups = math.ceil(groups / fan_in)
        lists = lists.withColumn("group", F.floor(F.col("group") / fan_in).cast("int"))
        lists = merged(lists.distinct(), F.col("query_id"), F.col("group")).drop("rank")
    return merged(lists.drop("group").distinct(), F.col("query_id")).select("query_id", F.col("rank").cast(T.IntegerType()), "vec_id", "score")
