"""A Merkle tree over the rows of a table: a subtree per group, one root, and each row's proof."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranking import numbered
from .shared import stored

#: Characters of a digest in hex, and levels that a block of nodes goes up at once: with 8 nodes to a run, a block has 512 nodes and its lowest level 32 KB.
WIDTH, LEVELS = 64, 3


def leaf_of(*values: Column) -> Column:
    """Digest of the values in order, each '-' if null, else its UTF-8 byte count, ':', and the value; integers in decimal."""
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string")), F.lit("-")) for v in values]), 256)


def _let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value), with value computed once."""
    return F.element_at(F.transform(F.array(value), f), 1)


def _text(parts: Column) -> Column:
    """A level of a block as one string, in bytes, of which a piece is cut without counting characters."""
    return F.array_join(parts, "").cast("binary")


def _parents(level: Column, fan: int) -> Column:
    run = WIDTH * fan
    last = F.ceil(F.octet_length(level) / run).cast("int") - 1
    return _text(F.transform(F.sequence(F.lit(0), last), lambda i: F.sha2(F.substring(level, i * run + 1, F.lit(run)), 256)))


def _blocks(nodes: DataFrame, fan: int) -> DataFrame:
    """Nodes (tree, place, n, hash, row) in aligned blocks: tree, n, block, rows in order, the levels l0, l1, l2 and top, the block's own node above these."""
    size = fan**LEVELS
    rows = F.array_sort(F.collect_list(F.struct("place", "hash", "row")))
    groups = nodes.groupBy("tree", "n", F.floor(F.col("place") / size).alias("block")).agg(rows.alias("rows"))

    def up(level: Column, j: int) -> Column:
        return F.when(F.col("n") > fan**j, _parents(level, fan)).otherwise(level)

    lowest = _text(F.transform("rows", lambda r: r["hash"]))
    levels = _let(lowest, lambda a: _let(up(a, 0), lambda b: _let(up(b, 1), lambda c: F.struct(a.alias("l0"), b.alias("l1"), c.alias("l2"), up(c, 2).cast("string").alias("top")))))
    return groups.select("tree", "n", "block", F.transform("rows", lambda r: r["row"]).alias("rows"), levels.alias("s")).select("tree", "n", "block", "rows", "s.*")


def _grow(nodes: DataFrame, fan: int, tag: str) -> list[DataFrame]:
    """The blocks of nodes, of the blocks' own nodes, and so on until each tree has one block; all stored."""
    rounds: list[DataFrame] = []
    while True:
        rounds.append(stored(_blocks(nodes, fan), f"{tag}{len(rounds)}"))
        most = rounds[-1].agg(F.max("n")).first()[0]
        if most is None or most <= fan**LEVELS:
            return rounds
        nodes = rounds[-1].select("tree", F.col("block").alias("place"), F.ceil(F.col("n") / fan**LEVELS).alias("n"), F.col("top").alias("hash"), F.lit(0).alias("row"))


def _below(blocks: DataFrame, above: DataFrame, fan: int, given: list[str]) -> DataFrame:
    """tree, place, row, hash, path and the columns given of every node in blocks, whose own path (and what is given) is in above (tree, block)."""
    spans = [fan**j for j in range(LEVELS)]

    def steps(i: Column) -> Column:
        out = []
        for level, span in zip(("l0", "l1", "l2"), spans, strict=True):
            at = F.floor(i / span).cast("int")
            run = F.floor(at / fan).cast("int") * fan
            left = F.substring(F.col(level), run * WIDTH + 1, (at - run) * WIDTH)
            right = F.substring(F.col(level), (at + 1) * WIDTH + 1, (run + fan - 1 - at) * WIDTH)
            out.append(F.when(F.col("n") > span, F.struct(left.alias("left"), right.alias("right"))))
        return F.array_compact(F.array(*out))

    def node(row: Column, i: Column) -> Column:
        return F.struct(
            (F.col("block") * fan**LEVELS + i).alias("place"), row.alias("row"), F.substring(F.col("l0"), i * WIDTH + 1, F.lit(WIDTH)).cast("string").alias("hash"), F.concat(steps(i), F.col("path")).alias("path"))

    both = blocks.join(above, ["tree", "block"])
    return both.select("tree", *given, F.explode(F.transform("rows", node)).alias("e")).select("tree", "e.*", *given)


def proof_text(path: Column) -> Column:
    """All siblings on a path, from below, left to right, as one string."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"]).cast("string")), "")


def fold(leaf: Column, path: Column) -> Column:
    """The root that leaf has with the siblings on its path."""
    return F.aggregate(path, leaf, lambda at, s: F.sha2(F.concat(s["left"], at.cast("binary"), s["right"]), 256))


def manifest(rows: DataFrame, columns: list[str], group: str, order: str, fan: int = 8, **kept: Column) -> DataFrame:
    """One row per row: order's column, the columns kept, place (in its group), leaf, subroot, root and path, the siblings (left, right) of each level from below.

    A leaf is leaf_of(columns). In each group leaves ascend by order (nulls first), equal ones by their digests; while a
    level has several nodes, each run of fan makes one of the next. The subroots, by group (null
    first), make the root likewise. A lone node is its own root, with an empty path; a table without
    rows gives none. Repeated rows are leaves each. fold() of a row's leaf and path is the root, and of
    another leaf is not.

    Nodes meet in aligned blocks of fan ** 3, each a row of one string per level; a
    level is cut into runs, and into the siblings of a node, by places alone. Blocks' own nodes make the
    next blocks. So no task holds more of a tree than one block at a time, however large the group, and paths come
    back down by joins on the block, a 512th of the rows of the level below.
    """
    made = stored(rows.select(F.col(order).alias("key"), F.col(group).cast("string").alias("grp"), leaf_of(*[F.col(c) for c in columns]).alias("hash"), *[c.alias(f"kept_{n}") for n, c in kept.items()]), "merkle-leaves")
    placed = numbered(made, ["key", "hash"], "grp", "merkle-places")
    trees = numbered(stored(made.select("grp").distinct(), "merkle-groups"), ["grp"], tag="merkle-trees").select(F.col("grp").alias("g"), F.col("place").alias("tree"))
    row = F.struct("key", *[f"kept_{n}" for n in kept])
    nodes = placed.join(trees, F.col("grp").eqNullSafe(F.col("g"))).select("tree", "place", "n", "hash", row.alias("row"))

    rounds = _grow(nodes, fan, "merkle-blocks")
    tops = rounds[-1].select("tree", F.col("top").alias("subroot"))
    over = _grow(tops.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("place"), F.lit(tops.count()).cast("long").alias("n"), F.col("subroot").alias("hash"), F.lit(0).alias("row")), fan, "merkle-tops")
    root = over[-1].select("tree", "block", F.col("top").alias("root"), F.array().cast("array<struct<left:binary,right:binary>>").alias("path"))
    for k, blocks in reversed(list(enumerate(over))):
        root = stored(_below(blocks, root, fan, ["root"]).select("tree", F.col("place").alias("block"), F.col("hash").alias("subroot"), "path", "root"), f"merkle-root{k}")
        root = root.drop("subroot") if k else root
    above = root.select(F.col("block").alias("tree"), F.lit(0).cast("long").alias("block"), "subroot", "root", "path")
    for k, blocks in reversed(list(enumerate(rounds))):
        found = _below(blocks, above, fan, ["subroot", "root"])
        if k:
            above = stored(found.select("tree", F.col("place").alias("block"), "subroot", "root", "path"), f"merkle-above{k}")
    return found.select(F.col("row.key").alias(order), *[F.col(f"row.kept_{n}").alias(n) for n in kept], "place", F.col("hash").alias("leaf"), "subroot", "root", "path")
