"""Connected components of an edge table: forests within each task, then alternating large-star and small-star steps."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .shared import stored

#: Nodes that a task holds before it hands its stars on.
HELD = 500_000


class Forest:
    """Union-find over any integers; the smallest of a component is its root."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def root(self, i: int) -> int:
        up = self.up
        up.setdefault(i, i)
        while up[i] != i:
            up[i] = i = up[up[i]]
        return i

    def join(self, i: int, j: int) -> bool:
        """Whether i and j were apart until now."""
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


def _stars(edges: DataFrame) -> DataFrame:
    """Edges a > b with the same components, each task's own as stars around their smallest node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest()

        def out() -> pa.RecordBatch:
            ends = [(i, r) for i in list(forest.up) if (r := forest.root(i)) != i]
            forest.up = {}
            return pa.RecordBatch.from_arrays([pa.array([e[k] for e in ends], pa.int64()) for k in (0, 1)], names=["a", "b"])

        for batch in batches:
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
                forest.join(a, b)
            if len(forest.up) >= HELD:
                yield out()
        yield out()

    return edges.select("a", "b").mapInArrow(run, "a bigint, b bigint")


def _counted(edges: DataFrame) -> tuple[DataFrame, tuple[int, int]]:
    """The stored edges, their number and a sum of their hashes, taken while they are written."""
    seen = Observation()
    out = stored(edges.observe(seen, F.count("*").alias("n"), F.sum(F.shiftright(F.xxhash64("a", "b"), 24)).alias("h")), "cc-edges")
    return out, (seen.get["n"], seen.get["h"] or 0)


def _least(pairs: DataFrame) -> DataFrame:
    """Pairs (u, v) and, per u, the smallest of u and all its v."""
    least = pairs.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return pairs.join(least, "u")


def components(edges: DataFrame) -> DataFrame:
    """node, root for every node of edges(a, b) that has another: root is the smallest node that can be reached.

    Hubs are no trouble: minima are aggregated before the shuffle and the joins may be
    split. The number of steps grows with the logarithm of the longest path, and each
    step is written to the shared folder. Self-loops and repeated edges are allowed.
    """
    edges, before = _counted(_stars(edges).distinct())
    while before[0]:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = _least(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = _least(large)
        small = small.select(F.inline(F.array(F.struct(F.col("v").alias("a"), F.col("m").alias("b")), F.struct(F.col("u").alias("a"), F.col("m").alias("b")))))
        edges, after = _counted(small.filter("a <> b").distinct())
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
