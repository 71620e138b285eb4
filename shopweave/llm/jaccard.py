"""N-gram Jaccard join: exact links and components of documents by their sets of word shingles.

Jaccard distance is a metric, so pivots and the triangle inequality bound where a
document's partners lie. Shingle sets of unrelated texts are all at distance 1 from each
other, though, and windows around a distance of 1 hold everything. So the first level
gathers sets by keys that any two linked sets have in common: one of the rarest shingles
of short sets, one of many hashed parts of longer ones. Sets that share a key are one
region; no link leaves a region.
Inside a region every set gets a pivot within reach: the first set without one becomes a
pivot, is measured against all sets, and is linked to those in reach, which are its Voronoi
cell. Near copies so cost one distance each. A set at the border of a cell of another
component visits that cell, and there meets the sets that the distances to all pivots allow.
Regions that are too large for a task do the same in chunks, with some pivots at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import Forest, components
from .shared import Remembered, discard, held, most_frequent, parted, stored

#: Words that a worker remembers the hashes of.
REMEMBERED = 300_000
#: Shingles and sets above which a region is joined in chunks; bounds the memory and rows of a task.
REGION, CROWD = 2_000_000, 128
#: Pivots that a large region gets at a time, and how often it gets more.
PIVOTS, ROUNDS = 16, 4
#: Sets of fewer shingles are gathered by their rarest shingles, others by hashed parts.
SHORT = 64
#: Sizes of longer sets grow by this from one size class to the next.
GROWTH = 1.5
#: Most shingles that are called common, and how many a task counts at a time.
COMMON, WINDOW = 200_000, 4_000_000
#: Stands for a null doc_id inside the join.
NO_ID = -(1 << 63)
#: Bits of the table of candidate documents that is sent to all tasks (512 KB).
TABLE_BITS = 22

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _M2
    return h ^ (h >> np.uint64(29))


class Shingler:
    """Sorted distinct 64-bit shingle hashes of texts: ASCII letters lower-cased, words are runs of anything but ASCII blanks."""

    def __init__(self, words: int):
        self.words = words
        self.hashes = Remembered(xxhash.xxh3_64_intdigest, REMEMBERED)

    def __call__(self, text: str | None) -> np.ndarray:
        tokens = text.encode().lower().split() if text else []
        if not tokens:
            return np.empty(0, dtype=np.uint64)
        h = np.fromiter(map(self.hashes.__getitem__, tokens), dtype=np.uint64, count=len(tokens))
        k = min(self.words, len(h))
        acc = np.full(len(h) - k + 1, k, dtype=np.uint64)  # k: a short text is no part of a longer shingle
        for i in range(k):
            acc = _mix(acc * _M1 + h[i : len(h) - k + 1 + i])
        return np.unique(acc)


class Reach:
    """What a threshold of t percent allows: size classes, numbers of parts, and the exact test."""

    def __init__(self, percent: int):
        if not 67 <= percent <= 100:  # below, sizes in reach could skip a size class
            raise ValueError("the threshold must be from 67 to 100 percent")
        self.t = percent
        self.radius = 1 - percent / 100

    def differing(self, total: int) -> int:
        """Most shingles in which two linked sets with total members together can differ."""
        return (100 - self.t) * total // (100 + self.t)

    def classes(self, n: int) -> list[tuple[int, int, int]]:
        """The size classes in which a set of n members, SHORT at least, looks for partners: number, parts, parts to be compared.

        How many parts there are is the class's; how many of them a set compares follows from its own size and that of the
        largest partner that it can have in the class, so it is one more than can differ.
        """
        hi, c = int(np.ceil(SHORT * GROWTH)), 0
        while n >= hi:
            hi, c = int(np.ceil(hi * GROWTH)), c + 1
        out = [self._parts(c, hi, n)]
        if 100 * n >= self.t * hi:  # the smallest sets of the next class may be in reach
            out.append(self._parts(c + 1, int(np.ceil(hi * GROWTH)), n))
        return out

    def _parts(self, c: int, hi: int, n: int) -> tuple[int, int, int]:
        most = self.differing(2 * (hi - 1))
        return c, most + 9 + most // 4, self.differing(n + min(hi - 1, 100 * n // self.t)) + 1

    def linked(self, both: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return 100 * both >= self.t * (a + b - both)

    def keys(self, s: np.ndarray, common: np.ndarray) -> np.ndarray:
        """Keys of the set s, of which it shares one with every other set that it is linked to.

        Of a pair with a short set, each has as many of its rarest shingles as may differ
        and one more. Longer ones have a key for each part to be compared. Of the parts, as many as are spare are left
        out, those with the fewest shingles that are not common first, which spares empty parts. Linked sets agree in
        one more part than either leaves out, so the last of these in this order has that many below it in both and is left out by
        neither. Which shingles are called common changes the work, not the result.
        """
        n = len(s)
        if not n or not self.differing(n + 100 * n // self.t):
            return np.empty(0, dtype=np.int64)  # linked to equal sets only, and those are one class already
        frequent = common[np.minimum(np.searchsorted(common, s), len(common) - 1)] == s if len(common) else np.zeros(n, dtype=bool)
        found = []
        least = -(-self.t * n // 100)
        if least < SHORT:
            found.append(_mix(s[np.lexsort((s, frequent))[: n - least + 1]] * _M1))
        rare = np.concatenate([[0], np.cumsum(~frequent)])
        for c, parts, compared in self.classes(n) if n >= SHORT else ():
            part = ((s >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
            starts = np.searchsorted(part, np.arange(parts + 1))
            sizes = np.diff(starts)
            sums = np.concatenate([[np.uint64(0)], np.cumsum(_mix(s * _M1), dtype=np.uint64)])
            content = sums[starts[1:]] - sums[starts[:-1]]
            order = ((rare[starts[1:]] - rare[starts[:-1]]) * (n + 1) + sizes) * parts + np.arange(parts)
            take = np.argpartition(order, parts - compared)[parts - compared :]
            found.append(_mix(content[take] + _mix(take.astype(np.uint64) * _M1 + np.uint64(c + 1))))
        return np.concatenate(found).view(np.int64)


def fingerprint(s: np.ndarray) -> int | None:
    return np.uint64(xxhash.xxh3_64_intdigest(s.tobytes())).astype(np.int64).item() if len(s) else None


def _doc_id(docs: DataFrame) -> Column:
    return F.coalesce(docs["doc_id"].cast("long"), F.lit(NO_ID)).alias("doc_id")


def common_shingles(docs: DataFrame, words: int, most: int = COMMON) -> np.ndarray:
    """At most `most` of the shingles that many texts share, sorted: passages, phrases, licence lines.

    All texts are read; a task counts in windows of WINDOW shingles and reports those that it
    meets in three different sets, so what it holds and what is collected is bounded.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, seen = held(("jaccard", words), lambda: Shingler(words)), Remembered(lambda fp: False, REMEMBERED)
        window: list[np.ndarray] = []

        def out() -> pa.RecordBatch:
            h, n = np.unique(np.concatenate(window), return_counts=True) if window else (np.empty(0, np.uint64), np.empty(0, np.int64))
            window.clear()
            return pa.RecordBatch.from_arrays([pa.array(h[n > 2].view(np.int64)), pa.array(n[n > 2].astype(np.int64))], names=["h", "whole"])

        held_now = 0
        for batch in batches:
            for text in batch.column("text").to_pylist():
                s = shingles(text)
                if len(s) and not seen[fp := fingerprint(s)]:
                    seen[fp] = True
                    window.append(s)
                    held_now += len(s)
                    if held_now >= WINDOW:
                        held_now = 0
                        yield out()
        yield out()

    counts = stored(docs.select("text").mapInArrow(run, "h bigint, whole bigint").groupBy("h").agg(F.sum("whole").alias("whole")), "jac-common")
    return np.sort(most_frequent(counts, most).select("h").toArrow().column("h").to_numpy().view(np.uint64))


def fingerprints(docs: DataFrame, words: int, percent: int, common: np.ndarray) -> DataFrame:
    """doc_id, n_shingles, fp (of the whole set; null if empty), keys (of each set once in a task)."""
    known = docs.sparkSession.sparkContext.broadcast(common)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, reach = held(("jaccard", words), lambda: Shingler(words)), Reach(percent)
        sent = Remembered(lambda fp: False, REMEMBERED)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                sizes, fps, keys = [], [], []
                for text in part.column("text").to_pylist():
                    s = shingles(text)
                    fp = fingerprint(s)
                    new = len(s) and not sent[fp]
                    if new:
                        sent[fp] = True
                    sizes.append(len(s))
                    fps.append(fp)
                    keys.append(reach.keys(s, known.value) if new else np.empty(0, dtype=np.int64))
                ends = np.concatenate([[0], np.cumsum([len(k) for k in keys])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(fps, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(keys)))],
                    names=["doc_id", "n_shingles", "fp", "keys"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id bigint, n_shingles bigint, fp bigint, keys array<bigint>")


def shared_parts(marked: DataFrame) -> DataFrame:
    """a, b: for every key that several sets have, the smallest of them and each other one.

    Rows are dealt by key and sorted, so a task reads each key's sets as one run and
    holds nothing but the run's first.
    """
    rows = marked.select(F.explode("keys").alias("key"), "fp").repartition("key").sortWithinPartitions("key", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first, last = None, 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            k = batch.column("key").to_numpy()
            v = batch.column("fp").to_numpy()
            # the run that the batch before left open goes on
            heads = np.concatenate([[key is None or k[0] != key], k[1:] != k[:-1]])
            starts = np.where(heads, np.arange(len(k)), -1)
            at = np.maximum.accumulate(starts)
            firsts = np.where(at >= 0, v[np.maximum(at, 0)], first)
            before = np.concatenate([[last if not heads[0] else ~v[0]], v[:-1]])
            keep = (v != firsts) & (heads | (v != before))
            key, first, last = k[-1], firsts[-1], v[-1]
            if keep.any():
                pairs = np.unique(np.stack([firsts[keep], v[keep]]), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])

    return rows.mapInArrow(run, "a bigint, b bigint")


class Sets:
    """Sets of shingles, for distances from one of them or from another set to many."""

    def __init__(self, sets: list[np.ndarray], reach: Reach):
        self.reach = reach
        self.sizes = np.array([len(s) for s in sets], dtype=np.int64)
        self.known, self.flat = np.unique(np.concatenate(sets), return_inverse=True)
        self.ends = np.cumsum(self.sizes)
        self.mark = np.zeros(len(self.known), dtype=np.uint8)

    def own(self, i: int) -> np.ndarray:
        return self.flat[self.ends[i] - self.sizes[i] : self.ends[i]]

    def shared(self, numbers: np.ndarray, others: np.ndarray | None = None) -> np.ndarray:
        """Size of what the shingles of these numbers share with each set, or each of the others."""
        self.mark[numbers] = 1
        if others is None:
            hit, sizes = self.mark[self.flat], self.sizes
        else:
            hit, sizes = self.mark[np.concatenate([self.own(j) for j in others])], self.sizes[others]
        self.mark[numbers] = 0
        return np.add.reduceat(hit, np.cumsum(sizes) - sizes, dtype=np.int64)

    def numbers(self, s: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.known, s), len(self.known) - 1)
        return at[self.known[at] == s]

    def away(self, size: int, both: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distances of all sets to one of the given size, and whether they are in reach."""
        return 1 - both / (self.sizes + size - both), self.reach.linked(both, self.sizes, size)


class Region(Sets):
    """Sets that one task joins with each other; visits counts how often a set looked into another cell."""

    def __init__(self, sets: list[np.ndarray], reach: Reach):
        super().__init__(sets, reach)
        self.forest, self.visits, self.pivots = Forest(), 0, []

    def join(self) -> None:
        n = len(self.sizes)
        free, rows = np.ones(n, dtype=bool), []
        for p in range(n):
            if free[p]:
                away, near = self.away(self.sizes[p], self.shared(self.own(p)))
                for j in np.nonzero(near)[0].tolist():
                    self.forest.join(p, j)
                free &= ~near
                self.pivots.append(p)
                rows.append(away)
        away = np.array(rows)
        cells, own = voronoi(away.T, self.reach.radius), away.argmin(axis=0)
        for c, p in enumerate(self.pivots):
            visitors = np.nonzero(cells[:, c] & (own != c))[0]
            inside = np.nonzero(own == c)[0] if len(visitors) else ()
            for i in visitors.tolist():
                if self.forest.root(i) != self.forest.root(p):  # all inside are linked to p
                    self.visits += 1
                    fit = inside[allowed(away[:, inside], away[:, [i]], self.reach.radius)]
                    if len(fit) and self.reach.linked(self.shared(self.own(i), fit), self.sizes[fit], self.sizes[i]).any():
                        self.forest.join(i, p)


def voronoi(away: np.ndarray, radius: float) -> np.ndarray:
    """Whether each document (row) belongs into each pivot's cell, from its distances.

    Its own cell is the nearest pivot's. A partner in another cell is nearer to that
    cell's pivot than to this one, so by the triangle inequality this document is at
    most 2 * radius farther from it; in all such cells it meets its partners.
    """
    return away <= away.min(axis=1, keepdims=True) + 2 * radius + 1e-9


def allowed(a: np.ndarray, b: np.ndarray, radius: float) -> np.ndarray:
    """Which of the columns, distances to the same pivots, differ nowhere by more than the radius: others are out of reach by the triangle inequality."""
    return (np.abs(a - b) <= radius + 1e-9).all(axis=0)


def _sets(table: pa.Table) -> list[np.ndarray]:
    return [np.frombuffer(h, dtype=np.uint64) for h in table.column("hashes").to_pylist()]


_EDGE = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def join_regions(sets: DataFrame, percent: int) -> DataFrame:
    """a, b: edges that connect what links connect among sets(region, fp, hashes), region by region, in one task each."""

    def run(table: pa.Table) -> pa.Table:
        fps, region = table.column("fp").to_pylist(), Region(_sets(table), Reach(percent))
        region.join()
        links = [(fps[i], fps[r]) for i in range(len(fps)) if (r := region.forest.root(i)) != i]
        return pa.table([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], schema=_EDGE)

    return sets.groupBy("region").applyInArrow(run, "a bigint, b bigint")


def join_large(crowd: DataFrame, percent: int) -> DataFrame:
    """a, b: the same for large regions of crowd(region, chunk, chunks, fp, n, hashes), in chunks.

    In each of ROUNDS, PIVOTS sets without a pivot in reach become pivots and are measured
    against all sets of their region, chunk by chunk. Then the sets outside of their region's largest
    component, few if the region is a crowd of near copies, meet those sets of other
    components that the distances to all pivots allow.
    """
    reach = Reach(percent)
    rounds: list[DataFrame] = []
    for k in range(ROUNDS):
        free = crowd
        if rounds:
            free = crowd.join(rounds[-1].filter("free").select("fp"), "fp", "left_semi")
        number = F.pmod(F.xxhash64("fp", F.lit(k)), F.lit(PIVOTS)).cast("int")
        pivots = free.groupBy("region", number.alias("pivot")).agg(F.min("fp").alias("fp")).select("fp", "pivot")
        pivots = stored(crowd.join(pivots, "fp").select("region", "chunks", "fp", "hashes", "pivot"), "jac-pivots")
        if pivots.isEmpty():
            break
        copies = pivots.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select("region", "chunk", "pivot", F.col("fp").alias("pivot_fp"), "hashes")
        both = crowd if not rounds else crowd.join(rounds[-1].select("fp", "free"), "fp")
        rows = both.select("region", "chunk", "fp", "hashes", (F.col("free") if rounds else F.lit(True)).alias("free"))

        def measure(docs: pa.Table, around: pa.Table) -> pa.Table:
            if not docs.num_rows:
                return pa.table([pa.array([], t) for t in _MEASURED.types], schema=_MEASURED)
            around = around.sort_by("pivot")
            sets, names = Sets(_sets(docs), reach), np.array(around.column("pivot_fp").to_pylist(), dtype=np.int64)
            got = [sets.away(len(p), sets.shared(sets.numbers(p))) for p in _sets(around)]
            away = np.array([a for a, _ in got]).reshape(len(got), docs.num_rows).T
            near = np.array([x for _, x in got], dtype=bool).reshape(len(got), docs.num_rows).T
            free = docs.column("free").to_numpy(zero_copy_only=False) & ~near.any(axis=1)
            return pa.table([docs.column("region"), docs.column("fp"), pa.array(free), pa.array([names[x].tolist() for x in near], pa.list_(pa.int64())), pa.array(away.tolist(), pa.list_(pa.float64()))], schema=_MEASURED)

        rounds.append(stored(rows.groupBy("region", "chunk").cogroup(copies.groupBy("region", "chunk")).applyInArrow(measure, "region bigint, fp bigint, free boolean, near array<bigint>, away array<double>"), "jac-measured"))
    links = rounds[0].select("fp", "near")
    away = rounds[0].select("fp", "away")
    for more in rounds[1:]:
        links = links.unionByName(more.select("fp", "near"))
        away = away.join(more.select("fp", F.col("away").alias("more")), "fp").select("fp", F.concat("away", "more").alias("away"))
    links = stored(links.select(F.col("fp").alias("a"), F.explode("near").alias("b")).filter("a <> b"), "jac-near")
    roots = components(links)
    who = crowd.select("region", "chunk", "chunks", "fp", "n").join(roots, F.col("fp") == F.col("node"), "left").withColumn("root", F.coalesce("root", "fp")).drop("node")
    who = stored(who.join(away, "fp"), "jac-who")
    # what is known of a region is dealt to its chunks, so that no join has the region alone as its key
    spread = lambda df: df.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).drop("chunks")
    sizes = who.groupBy("region", "chunks", "root").agg(F.count("*").alias("members")).groupBy("region", "chunks").agg(F.max_by("root", F.struct("members", "root")).alias("main"))
    rest = stored(who.join(spread(sizes), ["region", "chunk"]).filter("root <> main").drop("main"), "jac-rest")
    slices = rest.groupBy("region", "chunks").agg(F.greatest(F.ceil(F.count("*") / CROWD), F.ceil(F.sum("n") / REGION)).cast("int").alias("slices"))
    slices = stored(spread(slices), "jac-slices")
    sliced = rest.join(slices, ["region", "chunk"]).withColumn("slice", F.pmod(F.xxhash64("fp", F.lit(1)), F.col("slices")).cast("int"))
    sliced = stored(sliced.drop("chunk").join(crowd.select("fp", "hashes"), "fp"), "jac-sliced")
    rest = spread(sliced)
    there = who.join(slices, ["region", "chunk"]).join(crowd.select("fp", "hashes"), "fp").withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))

    def meet(docs: pa.Table, others: pa.Table) -> pa.Table:
        if not docs.num_rows or not others.num_rows:
            return pa.table([pa.array([], t) for t in _EDGE.types], schema=_EDGE)
        sets, found = Sets(_sets(others), reach), []
        fps, roots_ = others.column("fp").to_numpy(), others.column("root").to_numpy()
        far = np.array(others.column("away").to_pylist()).T
        for fp, root, own, s in zip(docs.column("fp").to_pylist(), docs.column("root").to_pylist(), docs.column("away").to_pylist(), _sets(docs), strict=True):
            fit = np.nonzero(allowed(far, np.array(own)[:, None], reach.radius) & (roots_ != root))[0]
            if len(fit):
                near = fit[reach.linked(sets.shared(sets.numbers(s), fit), sets.sizes[fit], len(s))]
                found += [(fp, int(fps[j])) for j in near]
        return pa.table([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], schema=_EDGE)

    keys, columns = ("region", "chunk", "slice"), ("fp", "root", "away", "hashes")
    left, right = rest.select(*keys, *columns), there.select(*keys, *columns)
    found = stored(links.unionByName(left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(meet, "a bigint, b bigint")), "jac-large-links")
    discard(*rounds, links, who, sliced)
    return found


_MEASURED = pa.schema([("region", pa.int64()), ("fp", pa.int64()), ("free", pa.bool_()), ("near", pa.list_(pa.int64())), ("away", pa.list_(pa.float64()))])


def rarest_keys(crowd: DataFrame, percent: int) -> DataFrame:
    """fp, keys: of each set of crowd(fp, n, hashes) as many shingles as it may lack in a linked set and one more, those that fewest sets of the crowd have first, of which those are left that it shares.

    Linked sets share one of these, whatever the order, so sets that share none are not linked.
    Sets without any key are linked to no other set and left out.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                sizes = part.column("n").to_numpy()
                keys = np.frombuffer(b"".join(part.column("hashes").to_pylist()), dtype=np.int64)
                least = -(-percent * sizes // 100)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.repeat(part.column("fp").to_numpy(), sizes)), pa.array(np.repeat(least - 1, sizes))], names=["key", "fp", "rest"])

    rows = crowd.select("fp", "n", "hashes").mapInArrow(each, "key bigint, fp bigint, rest bigint")
    whole = rows.groupBy("key").agg(F.count("*").alias("whole")).filter("whole > 1")
    # a set's shingles by rising count end with as many as are no keys
    mine = rows.join(whole, "key").groupBy("fp", "rest").agg(F.sort_array(F.collect_list(F.struct("whole", "key"))).alias("mine")).filter(F.size("mine") > F.col("rest"))
    return mine.select("fp", F.slice("mine.key", F.lit(1), (F.size("mine") - F.col("rest")).cast("int")).alias("keys"))


def apart(crowd: DataFrame, percent: int) -> DataFrame:
    """region, fp, n, hashes of those sets of crowd, smaller regions instead of large ones: sets share a region if rarest_keys connect them.

    Of what is common at first the most frequent shingles alone are known, so in a large corpus regions also hang together by
    shingles that are neither rare nor among these, and then mostly hold sets that have nothing to do with each other.
    """
    met = stored(shared_parts(rarest_keys(crowd, percent)).distinct(), "jac-apart")
    found = components(met).select(F.col("node").alias("fp"), F.col("root").alias("region"))
    out = stored(crowd.select("fp", "n", "hashes").join(found, "fp").select("region", "fp", "n", "hashes"), "jac-regions")
    discard(met)
    return out


def _large(sets: DataFrame, largest: int) -> DataFrame:
    """region, chunks of the regions of sets that are too large for a task."""
    weights = sets.groupBy("region").agg(F.sum("n").alias("weight"), F.count("*").alias("members")).filter((F.col("weight") > largest) | (F.col("members") > CROWD))
    chunks = F.greatest(F.ceil(2 * F.col("weight") / largest), F.ceil(F.col("members") / CROWD)).cast("int")
    return stored(weights.select("region", chunks.alias("chunks")), "jac-large")


def join_all(sets: DataFrame, percent: int, largest: int = REGION) -> DataFrame:
    """a, b: edges that connect what links connect among sets(region, fp, n, hashes); large regions are those of more than largest shingles or CROWD sets, and are first taken apart."""
    large = _large(sets, largest)
    if large.isEmpty():
        return join_regions(sets, percent)
    found = join_regions(sets.join(large.select("region"), "region", "left_anti"), percent)
    crowd = stored(sets.join(large.select("region"), "region").dropDuplicates(["fp"]), "jac-crowd")
    parts = apart(crowd, percent)
    discard(crowd)
    still = _large(parts, largest)
    found = found.unionByName(join_regions(parts.join(still.select("region"), "region", "left_anti"), percent))
    if still.isEmpty():
        return found
    crowd = stored(parts.join(still, "region").withColumn("chunk", F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")), "jac-crowd")
    found = found.unionByName(join_large(crowd, percent))
    discard(crowd)
    return found


def _slot(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(1 << TABLE_BITS))


def _candidate_table(ids: DataFrame) -> np.ndarray:
    """One bit per hash of doc_id, set where a candidate has that hash; its size is fixed, whatever the number of candidates."""
    slots = ids.select(_slot(F.col("doc_id")).alias("slot"))
    bit = F.expr("shiftleft(1L, cast(slot & 31 as int))")
    table = np.zeros(1 << TABLE_BITS >> 5, dtype=np.uint32)
    for r in slots.groupBy(F.shiftright("slot", 5).alias("word")).agg(F.bit_or(bit).alias("bits")).collect():
        table[r["word"]] = r["bits"]
    return np.unpackbits(table.view(np.uint8), bitorder="little").astype(bool)


def candidate_sets(docs: DataFrame, members: DataFrame, words: int) -> DataFrame:
    """region, fp, n, hashes of the documents in members(doc_id, fp, region): texts are read again, the table of bits spares most of the work."""
    sent = docs.sparkSession.sparkContext.broadcast(np.packbits(_candidate_table(members)))
    rows = docs.select(_doc_id(docs), "text").withColumn("slot", _slot(F.col("doc_id")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, shingles = np.unpackbits(sent.value).astype(bool), held(("jaccard", words), lambda: Shingler(words))
        given = Remembered(lambda row: False, REMEMBERED)
        for batch in batches:
            hit = np.nonzero(table[batch.column("slot").to_numpy()])[0]
            for at in range(0, len(hit), 512):
                part = batch.take(pa.array(hit[at : at + 512]))
                rows = []
                for i, t in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                    s = shingles(t)
                    if not given[row := (i, fingerprint(s))]:
                        given[row] = True
                        rows.append((*row, len(s), s.tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.binary()))], names=["doc_id", "fp", "n", "hashes"])

    sets = rows.mapInArrow(run, "doc_id bigint, fp bigint, n bigint, hashes binary")
    return sets.join(members, ["doc_id", "fp"]).select("region", "fp", "n", "hashes")


def jaccard_components(docs: DataFrame, words: int = 5, percent: int = 80, largest: int = REGION) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of docs(doc_id, text).

    Two documents link when 100 * common shingles >= percent * shingles of both; a
    shingle is `words` words in a row, the whole text where it has fewer. component_id
    is the smallest doc_id reachable by links, its own included. Null or blank texts have
    no shingles, link with nothing and keep their own doc_id. A null doc_id is nobody's
    smallest and gets its component's, null if that has none. Rows that share a doc_id
    but not the text are judged by their own texts. Other columns of docs are ignored;
    an empty table gives no rows. Sets are told apart by 64-bit hashes, at a billion
    different sets with a chance of 3 % that any two are taken for one.
    """
    return _named(*_found(docs, words, percent, largest))


def _found(docs: DataFrame, words: int, percent: int, largest: int) -> tuple[DataFrame, DataFrame]:
    """marked(doc_id, n_shingles, fp) for every row and named(fp, component_id), both stored; all else that was stored is gone."""
    known_at = stored(fingerprints(docs, words, percent, common_shingles(docs, words)), "jac-keyed")
    marked = stored(known_at.drop("keys"), "jac-marked")
    known = known_at.filter("fp IS NOT NULL")
    classes = stored(known.groupBy("fp").agg(F.min("doc_id").alias("least"), F.min(F.coalesce("doc_id", F.lit(NO_ID))).alias("doc_id")), "jac-classes")
    met = stored(shared_parts(known.filter(F.size("keys") > 0)).distinct(), "jac-met")
    discard(known_at)
    regions = components(met).select(F.col("node").alias("fp"), F.col("root").alias("region"))
    members = stored(regions.join(classes, "fp").select("doc_id", "fp", "region"), "jac-members")
    one_each = stored(candidate_sets(docs, members, words), "jac-sets")
    links = stored(join_all(one_each, percent, largest), "jac-links")
    discard(met, members, one_each)
    tied = components(links).select(F.col("node").alias("fp"), "root").join(classes.select("fp", "least"), "fp")
    lowest = tied.groupBy("root").agg(F.min("least").alias("lowest"))
    named = classes.select("fp", "least").join(tied.select("fp", "root"), "fp", "left").join(lowest, "root", "left")
    named = stored(named.select("fp", F.coalesce("lowest", "least").alias("component_id")), "jac-named")
    discard(classes, links)
    return marked, named


def _named(marked: DataFrame, named: DataFrame) -> DataFrame:
    return (marked.select("doc_id", "n_shingles", "fp").join(named, "fp", "left")
            .select("doc_id", "n_shingles", F.when(F.col("fp").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")))


def keep_one_row(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row of docs(doc_id, text), all columns, of each component: that of the smallest doc_id, null last.

    Rows are compared, not ids: rows that repeat a doc_id or have none are copies if their
    texts are, and rows that share a doc_id with other texts stay. Rows without shingles stay.
    """
    key = F.xxhash64(docs["doc_id"].cast("long"), docs["text"].isNull(), docs["text"])
    marked, named = _found(docs.select(key.alias("doc_id"), "text"), words, percent, REGION)
    # rows are told apart by their id and text, and only these keys are compared; which of equal rows stays is all the same
    ids = docs.select(key.alias("key"), F.col("doc_id").cast("long").alias("id")).groupBy("key").agg(F.first("id").alias("id"), F.count("*").alias("rows"))
    found = _named(marked, named).filter("n_shingles > 0").select(F.col("doc_id").alias("key"), "component_id").distinct().join(ids, "key")
    found = stored(found, "jac-found")
    order = F.struct(F.col("id").isNull(), "id", "key")
    kept = found.groupBy("component_id").agg(F.min_by(F.struct("key", "rows"), order).alias("k")).select("k.key", "k.rows")
    # what changes: keys of which nothing stays, and those kept of which only one row does
    gone = found.select("key").join(kept.select("key"), "key", "left_anti").withColumn("rows", F.lit(0).cast("long"))
    changed = stored(gone.unionByName(kept.filter("rows > 1")).select(F.col("key").alias("__jac_key"), F.col("rows").alias("__jac_rows")), "jac-changed")
    discard(marked, named, found)
    # most rows are certainly not among them and stay where they were read
    maybe, rest = parted(docs.withColumn("__jac_key", key), F.col("__jac_key"), changed.select("__jac_key"))
    stay = maybe.join(changed, "__jac_key", "left_anti")
    once = maybe.join(changed.filter("__jac_rows > 1").select("__jac_key"), "__jac_key", "left_semi").dropDuplicates(["__jac_key"])
    return rest.unionByName(stay).unionByName(once).select(*docs.columns)
