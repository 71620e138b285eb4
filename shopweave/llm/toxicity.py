"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Vectors are made of all words of a text, and of those word beginnings that the labelled examples tie
to the toxic class. Document frequencies are those of all documents. Words and
beginnings that the examples tie to the class weigh more, by how much more often toxic
texts have them; no word is left out. A text's nearest examples vote by distance, and
are its evidence. The vote becomes a probability by a map fitted to the votes that the
examples get from each other.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import discard, hashed_share, held, parted, stored

#: Runs of letters and digits.
_WORD = re.compile(r"[^\W_]+")
#: Lengths of word beginnings that are terms of their own, for inflected and compound words.
BEGINNINGS = (4, 5, 6)
#: Added to a distance, and the power of what that gives, in the weight of a vote.
CLOSE, POWER = 0.05, 2
#: Pull of the map from votes to scores to leaving them as they are.
PULL = 1.0
#: Examples in a block, blocks that are looked at first, and the share of examples from which on a term is frequent.
BLOCK, FIRST, FREQUENT = 512, 2, 1 / 16
#: Places in a table of counts that are handed on together.
HANDED = 1024
#: Digits of cosines that decide which is nearer: single precision has no more.
DIGITS = 6
#: Words that a worker remembers.
REMEMBERED = 100_000
EVIDENCE = "array<struct<doc_id:bigint,similarity:double,toxic:bigint,clean:bigint>>"
OUT = f"held_out boolean, score double, predicted int, evidence {EVIDENCE}"
ITEM = pa.struct([("doc_id", pa.int64()), ("similarity", pa.float64()), ("toxic", pa.int64()), ("clean", pa.int64())])


def words(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def terms_of(word: str) -> list[str]:
    """The word itself, and its beginnings, which end in a star."""
    return [word, *(word[:n] + "*" for n in BEGINNINGS if len(word) > n)]


def held_out(doc_id: Column, folds: int = 5) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == 0, F.lit(False))


def sample_labels(labels: DataFrame, per_class: int) -> DataFrame:
    """Training rows of each class, by hash at most about per_class: doc_id, toxic. Where labels of a document differ, toxic wins."""
    known = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = stored(known.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic")), "tox-known")
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    parts = [hashed_share(known.filter(F.col("toxic") == c), "doc_id", sizes.get(c, 0), per_class) for c in (0, 1)]
    return parts[0].unionByName(parts[1])


def choose_terms(examples: DataFrame, most: int, least_share: float = 0.01, least_ratio: float = 5.0) -> dict[str, float]:
    """At most `most` terms that examples(text, toxic) tie to the toxic class, strongest first, each with its weight of 1 + the square of its log ratio.

    A term must occur in 3 toxic texts and in least_share of them, least_ratio times as
    often as in clean ones, and pass a likelihood-ratio test at a level that allows for
    how many terms are tried. Equal texts count once.
    """
    schema = "term string, toxic bigint, clean bigint"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: tuple[Counter, Counter] = (Counter(), Counter())
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                seen[toxic].update(set(chain.from_iterable(map(terms_of, set(words(text))))))
                seen[toxic][""] += 1  # the number of texts
            names = list(seen[0].keys() | seen[1].keys())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *(pa.array([seen[c][n] for n in names], pa.int64()) for c in (1, 0))], names=["term", "toxic", "clean"])

    once = examples.filter("text IS NOT NULL").groupBy(F.xxhash64("text"), F.length("text")).agg(F.first("text").alias("text"), F.max("toxic").alias("toxic"))
    counts = stored(once.select("text", "toxic").mapInArrow(count, schema).groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")), "tox-terms")
    totals = counts.filter("term = ''").collect()
    if not totals or not totals[0]["toxic"]:
        return {}
    n1, n0 = totals[0]["toxic"], totals[0]["clean"]
    often = counts.filter((F.col("term") != "") & (F.col("toxic") >= max(3, least_share * n1)))
    tried = max(2, often.count())
    a, b, share = F.col("toxic").cast("double"), F.col("clean").cast("double"), n1 / (n1 + n0)
    part = lambda k, s: F.when(k > 0, k * F.log(k / ((a + b) * s))).otherwise(0.0)
    scored = often.withColumn("ratio", (a + 0.5) / (n1 + 1.0) / ((b + 0.5) / (n0 + 1.0))).withColumn("lr", 2 * (part(a, share) + (part(b, 1 - share) if n0 else F.lit(0.0))))
    bar = 2 * math.log(tried) + 4 if n0 else 0.0
    kept = scored.filter((F.col("ratio") >= (least_ratio if n0 else 0.0)) & (F.col("lr") >= bar))
    return {r["term"]: 1 + max(0.0, math.log(r["ratio"])) ** 2 for r in kept.orderBy(F.desc("lr"), "term").limit(most).collect()}


def word_hash(word: str) -> int:
    h = xxhash.xxh3_64_intdigest(word)
    return h - (1 << 64) if h >> 63 else h


def vocabulary(examples: DataFrame) -> np.ndarray:
    """Sorted 64-bit hashes of all words of the examples, which are at most two classes of per_class texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = {w for t in batch.column("text").to_pylist() for w in words(t)}
            yield pa.RecordBatch.from_arrays([pa.array([word_hash(w) for w in seen], pa.int64())], names=["h"])

    return np.sort(examples.select("text").mapInArrow(run, "h bigint").distinct().toArrow().column("h").to_numpy())


class Numbers:
    """Numbers of words in the vocabulary, and of the tied beginnings, which come after them."""

    def __init__(self, known: np.ndarray, tied: list[str]):
        self.known, self.size = known, len(known) + len(tied)
        self.tied = {t: len(known) + i for i, t in enumerate(tied)}
        self.heads = {t[: BEGINNINGS[0]] for t in tied}
        self.several: list[tuple[int, list[int]]] = []
        self.places: dict[tuple[int, ...], int] = {}
        # two generations, so that frequent words stay
        self.new: dict[str, int] = {}
        self.old: dict[str, int] = {}

    def find(self, some: list[str]) -> np.ndarray:
        """The words' numbers, -1 if no example has them."""
        h = np.fromiter(map(word_hash, some), dtype=np.int64, count=len(some))
        if not len(self.known):
            return np.full(len(some), -1)
        at = np.minimum(np.searchsorted(self.known, h), len(self.known) - 1)
        return np.where(self.known[at] == h, at, -1)

    def codes(self, flat: list[str]) -> np.ndarray:
        """For each word its number, or, if it has tied beginnings, -2 less the place in several of all its numbers."""
        if len(self.new) > REMEMBERED:
            self.new, self.old = {}, self.new
        fresh = []
        for w in set(flat).difference(self.new):
            if w in self.old:
                self.new[w] = self.old[w]
            else:
                fresh.append(w)
        self.new.update(zip(fresh, self.find(fresh).tolist(), strict=True))
        for w in fresh if self.tied else ():
            if w[: BEGINNINGS[0]] in self.heads and (own := [self.tied[t] for n in BEGINNINGS if len(w) > n and (t := w[:n] + "*") in self.tied]):
                # words of the same numbers share a place, so that this does not grow with the texts
                key = (self.new[w], *own)
                if key not in self.places:
                    self.places[key] = len(self.several)
                    self.several.append((key[0], own))
                self.new[w] = -2 - self.places[key]
        return np.fromiter(map(self.new.__getitem__, flat), dtype=np.int64, count=len(flat))


def vectors(docs: DataFrame, numbers: tuple[np.ndarray, list[str]]) -> DataFrame:
    """doc_id, text_hash, ids and counts of the terms in each whole text, rest: what words of no example add to its squared length, in units of theirs."""
    sent, mark = docs.sparkSession.sparkContext.broadcast(numbers), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers_ = held(("toxicity", mark), lambda: Numbers(*sent.value))
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                bags = [Counter(words(t)) for t in part.column("text").to_pylist()]
                sizes = np.array([len(g) for g in bags])
                ids = numbers_.codes(list(chain.from_iterable(bags)))
                counts = np.fromiter(chain.from_iterable(g.values() for g in bags), dtype=np.int64, count=len(ids))
                doc = np.repeat(np.arange(len(bags)), sizes)
                more: list[tuple[int, int, int]] = []
                for i in np.nonzero(ids < -1)[0].tolist():
                    ids[i], own = numbers_.several[-2 - ids[i]]
                    more += ((int(doc[i]), t, int(counts[i])) for t in own)
                unknown = ids < 0
                rest = np.bincount(doc[unknown], (1 + np.log(counts[unknown])) ** 2, minlength=len(bags)).astype(float)
                doc, ids, counts = doc[~unknown], ids[~unknown], counts[~unknown]
                if more:
                    once: Counter = Counter()
                    for d, t, c in more:
                        once[d, t] += c
                    doc, ids, counts = (np.concatenate([x, y]) for x, y in zip((doc, ids, counts), ([d for d, _ in once], [t for _, t in once], list(once.values())), strict=True))
                    order = np.argsort(doc, kind="stable")
                    doc, ids, counts = doc[order], ids[order], counts[order]
                edges = pa.array(np.searchsorted(doc, np.arange(len(bags) + 1)), pa.int32())
                lists = (pa.ListArray.from_arrays(edges, pa.array(x.astype(np.int32))) for x in (ids, counts))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text_hash"), *lists, pa.array(rest)], names=["doc_id", "text_hash", "ids", "counts", "rest"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(run, "doc_id bigint, text_hash bigint, ids array<int>, counts array<int>, rest double")


def document_frequencies(found: DataFrame, size: int) -> tuple[np.ndarray, int]:
    """In how many rows of found(ids) each of size terms is, and the number of rows. Tasks hand on their counts in blocks, which are summed as they come."""
    blocks = -(-size // HANDED)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(blocks * HANDED, dtype=np.int32), 0
        for batch in batches:
            total += np.bincount(batch.column("ids").flatten().to_numpy(), minlength=len(total)).astype(np.int32)
            rows += batch.num_rows
        yield pa.RecordBatch.from_arrays([pa.array([-1]), pa.array([np.array([rows], dtype=np.int32).tobytes()], pa.binary())], names=["block", "counts"])
        used = np.nonzero(total.reshape(-1, HANDED).any(axis=1))[0]
        for at in range(0, len(used), 256):
            some = used[at : at + 256]
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array([b.tobytes() for b in total.reshape(-1, HANDED)[some]], pa.binary())], names=["block", "counts"])

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, c in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                total[k] = total.get(k, 0) + np.frombuffer(c, dtype=np.int32).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array([c.tobytes() for c in total.values()], pa.binary())], names=["block", "counts"])

    schema = "block bigint, counts binary"
    got = found.select("ids").mapInArrow(count, schema).repartition("block").mapInArrow(add_up, schema).toArrow()
    df, rows = np.zeros(blocks * HANDED, dtype=np.int64), 0
    for k, c in zip(got.column("block").to_pylist(), got.column("counts").to_pylist(), strict=True):
        if k < 0:
            rows = int(np.frombuffer(c, dtype=np.int64)[0])
        else:
            df[k * HANDED : (k + 1) * HANDED] = np.frombuffer(c, dtype=np.int64)
    return df[:size], rows


class BlockMaxIndex:
    """Examples as postings, in blocks of entries with the largest weight of each term.

    Given are each entry's terms and weights, one entry after the other. Neighbours share a block; bounds are tight where they are alike.
    Of equal cosines that of the smaller rank (else number) counts. Terms of very many entries are kept as rows of a matrix, whose product is exact and
    sharpens the bounds of the others.
    """

    def __init__(self, sizes: np.ndarray, term: np.ndarray, weight: np.ndarray, n_terms: int, block: int = BLOCK, rank: np.ndarray | None = None):
        self.rank = np.arange(len(sizes)) if rank is None else rank
        self.block, self.blocks = block, max(1, -(-len(sizes) // block))
        entry = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        often = np.nonzero(np.bincount(term, minlength=n_terms) > max(8, FREQUENT * len(sizes)))[0]
        self.row = np.full(n_terms, -1, dtype=np.int32)
        self.row[often] = np.arange(len(often))
        self.rows = np.zeros((len(often), self.blocks * block), dtype=np.float32)
        dense = self.row[term] >= 0
        self.rows[self.row[term[dense]], entry[dense]] = weight[dense]
        sparse = np.nonzero(~dense)[0].astype(np.int32)
        sparse = sparse[np.argsort(term[sparse], kind="stable")]
        # entry and weight lie side by side, as one number of 8 bytes, so that one look finds both
        postings = np.empty((len(sparse), 2), dtype=np.int32)
        postings[:, 0], term, postings[:, 1] = entry[sparse], term[sparse], weight[sparse].astype(np.float32).view(np.int32)
        del entry, dense, sparse
        of, heaviest = (postings[:, 0] // block).astype(np.int32), postings[:, 1].view(np.float32)
        self.postings = postings.view(np.int64).ravel()
        heads = np.nonzero(np.concatenate([[True], (term[1:] != term[:-1]) | (of[1:] != of[:-1])])[: len(term)])[0]
        self.run_start, self.run_block = heads.astype(np.int32), of[heads]
        self.run_length = np.diff(np.append(heads, len(term))).astype(np.int16)
        self.run_most = np.maximum.reduceat(heaviest, heads) if len(heads) else np.empty(0, dtype=np.float32)
        self.term_runs = np.searchsorted(term[heads], np.arange(n_terms + 1)).astype(np.int32)

    def frequent(self, terms: list[np.ndarray], weights: list[np.ndarray]) -> np.ndarray:
        """What the frequent terms add to the cosines of queries (rows) to all entries."""
        q = np.zeros((len(terms), len(self.rows)), dtype=np.float32)
        for i, (t, w) in enumerate(zip(terms, weights, strict=True)):
            row = self.row[t]
            q[i, row[row >= 0]] = w[row >= 0]
        return q @ self.rows

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int, without: int = -1, frequent: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The k entries of highest positive cosine and their cosines, exactly, but not the entry `without`; what is equal to DIGITS digits is a tie, which the smaller rank wins.

        Blocks whose bound is below the k-th best are skipped. frequent: the query's row of that, if it is known.
        """
        row = self.row[terms]
        scores = (self.frequent([terms], [weights])[0] if frequent is None else frequent).astype(float)
        terms, weights = terms[row < 0], weights[row < 0].astype(np.float32)
        lo = self.term_runs[terms]
        n = self.term_runs[terms + 1] - lo
        ends = np.cumsum(n)
        runs = np.repeat(lo - ends + n, n)
        runs += np.arange(len(runs))
        q, of = np.repeat(weights, n), self.run_block.take(runs).astype(np.intp)
        by_block = scores.reshape(self.blocks, self.block)
        bound = by_block.max(axis=1) + np.bincount(of, q * self.run_most.take(runs), minlength=self.blocks)
        done = np.zeros(self.blocks, dtype=bool)

        def look(at: np.ndarray) -> None:
            take = np.zeros(self.blocks, dtype=bool)
            take[at] = done[at] = True
            mine = np.nonzero(take.take(of))[0]
            r = runs.take(mine)
            size = self.run_length.take(r).astype(np.intp)
            place = np.repeat(self.run_start.take(r) - np.cumsum(size) + size, size)
            place += np.arange(len(place))
            found = self.postings.take(place)
            scores[:] += np.bincount(found.view(np.int32)[::2], np.repeat(q.take(mine), size) * found.view(np.float32)[1::2], minlength=len(scores))

        def best() -> np.ndarray:
            rows = np.nonzero(done)[0]
            got = by_block[rows].ravel()
            if without >= 0 and done[without // self.block]:
                got[np.searchsorted(rows, without // self.block) * self.block + without % self.block] = 0
            least = np.partition(got, len(got) - k)[len(got) - k] if len(got) > k else 0.0
            live = np.nonzero((got > 0) & (got >= least - 10.0**-DIGITS))[0]
            live = rows[live // self.block] * self.block + live % self.block
            return live[np.lexsort((self.rank[live], -np.round(scores[live], DIGITS)))][:k]

        look(np.argsort(-bound, kind="stable")[:FIRST])
        found = best()
        least = scores[found[-1]] if len(found) == k else 0.0
        more = np.nonzero(~done & (bound > 0) & (bound >= least - 2 * 10.0**-DIGITS))[0]
        if len(more):
            look(more)
            found = best()
        return found, np.minimum(scores[found], 1.0)


def arranged(about: list[tuple[int, int, int, int]], ids: np.ndarray, counts: np.ndarray, sizes: np.ndarray, weight: np.ndarray, boosted: np.ndarray) -> tuple:
    """about, sizes, ids and unit weights of the entries, ordered so that those with the same strongest tied term, or else the same most frequent word, are neighbours."""
    first = np.cumsum(sizes) - sizes
    w = ((1 + np.log(counts)) * weight[ids]).astype(np.float32)
    w /= np.repeat(np.sqrt(np.add.reduceat(w * w, first)) if len(ids) else w, sizes)
    lead = np.array([(-1, x[c.argmax()]) if not b.any() else (x[(v * b).argmax()], -1) for x, c, v, b in zip(*(np.split(a, first[1:]) for a in (ids, counts, w, boosted[ids])), strict=True)]).reshape(-1, 2)
    order = np.lexsort((np.arange(len(about)), lead[:, 1], lead[:, 0]))
    at = np.repeat(first[order] - np.cumsum(sizes[order]) + sizes[order], sizes[order]) + np.arange(len(ids))
    return [about[i] for i in order], sizes[order], ids[at].astype(np.int32), w[at]


class Examples:
    """The index of the examples as arranged, and how the nearest of them vote."""

    def __init__(self, entries: tuple, weight: np.ndarray, new: float, k: int):
        self.about, sizes, ids, unit = entries
        self.k, self.weight, self.new = k, weight, new
        self.members = [np.array([x[i] for x in self.about], dtype=np.int64) for i in range(3)]
        self.toxic = self.members[1] / (self.members[1] + self.members[2])
        self.place = {h: i for i, (_, _, _, h) in enumerate(self.about)}
        # ties go to the smaller doc_id, however the entries are arranged
        rank = np.empty(len(self.about), dtype=np.int32)
        rank[sorted(range(len(rank)), key=lambda i: (self.about[i][0], self.about[i][3]))] = np.arange(len(rank))
        self.index = BlockMaxIndex(sizes, ids, unit, len(weight), rank=rank)

    def votes(self, ids: list[np.ndarray], counts: list[np.ndarray], rest: list[float], without: list[int] | None = None) -> list[tuple[float, np.ndarray, np.ndarray]]:
        """For each text the share of toxic votes, one weak vote of the class share among them, and the voters and their cosines."""
        prior = float(self.toxic.mean())
        queries = []
        for i, c, r in zip(ids, counts, rest, strict=True):
            w = (1 + np.log(c)) * self.weight[i]
            queries.append(w / math.sqrt(w @ w + r * self.new**2) if len(i) else w)
        frequent, out = self.index.frequent(ids, queries), []
        for n, (i, w) in enumerate(zip(ids, queries, strict=True)):
            if not len(i):
                out.append((prior, np.empty(0, dtype=int), np.empty(0)))
                continue
            found, cosine = self.index.nearest(i, w, self.k, -1 if without is None else without[n], frequent[n])
            votes = 1 / (1 - cosine + CLOSE) ** POWER
            out.append((float((prior + votes @ self.toxic[found]) / (1 + votes.sum())), found, cosine))
        return out


def calibration(votes: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """a, b of 1 / (1 + exp(-a * logit(vote) - b)) that fit the labels best; a stays positive, so that order is kept."""
    x = np.stack([np.log(votes / (1 - votes)), np.ones(len(votes))])
    at = np.array([1.0, 0.0])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(at @ x, -30, 30)))
        slope = x @ (weight * (toxic - p)) - PULL * (at - [1.0, 0.0])
        at = at + np.clip(np.linalg.solve((x * (weight * p * (1 - p))) @ x.T + PULL * np.eye(2), slope), -1, 1)
        at[0] = max(at[0], 0.05)
    return round(float(at[0]), 6), round(float(at[1]), 6)


def score_toxicity(docs: DataFrame, labels: DataFrame, k: int = 15, per_class: int = 10_000, max_terms: int = 2_000) -> DataFrame:
    """doc_id, text_hash, held_out, score, predicted, evidence for every row of docs(doc_id, text).

    labels(doc_id, toxic) teach only through rows with crc32(doc_id as text) mod 5 not 0, of
    which at most per_class of each class are examples, which bounds what is broadcast; at most
    max_terms terms weigh more than others, none is left out. Document frequencies count all of docs;
    words of no example weigh as if no document had them. The k nearest distinct examples vote, each
    weighted by 1 / (distance + CLOSE) ** POWER, with one weak vote for the class share. score is
    that vote after a logistic map, fitted to the votes that examples get from all others. An example that is
    scored as a document meets itself. Null or empty text, or text without any word of an example, has the class share for its vote. Without toxic labels every
    score is 0. Of examples equally near, that of the smaller doc_id votes; examples are told apart by their
    texts, so rows may share a doc_id. Repeated rows score alike. Other columns are ignored.
    """
    return _scored(docs, labels, k, per_class, max_terms)[0]


def _scored(docs: DataFrame, labels: DataFrame, k: int, per_class: int, max_terms: int) -> tuple[DataFrame, DataFrame]:
    """The scores, and the stored table of vectors that they are made from."""
    sample = stored(sample_labels(labels, per_class), "tox-sample")
    examples = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    boosted = choose_terms(examples, max_terms)
    tied = [t for t in boosted if t.endswith("*")]
    known = vocabulary(examples)
    found = stored(vectors(docs, (known, tied)), "tox-vectors")
    numbers = Numbers(known, tied)
    df, n_docs = document_frequencies(found, numbers.size)
    boost = np.ones(numbers.size)
    for t, g in boosted.items():
        boost[numbers.tied[t] if t in numbers.tied else numbers.find([t])[0]] = g
    # examples with equal texts are one entry that counts for all of them; those without words are none
    entries = (found.join(F.broadcast(sample), "doc_id").filter(F.size("ids") > 0).groupBy("text_hash")
               .agg(F.min("doc_id").alias("doc_id"), F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean"), F.first("ids").alias("ids"), F.first("counts").alias("counts"))).toArrow().combine_chunks().sort_by([("doc_id", "ascending"), ("text_hash", "ascending")])
    schema = f"doc_id bigint, text_hash bigint, {OUT}"
    rows = found.select("doc_id", "text_hash", held_out(F.col("doc_id")).alias("held_out"), "ids", "counts", "rest")
    about = list(zip(*(entries.column(c).to_pylist() for c in ("doc_id", "toxic", "clean", "text_hash")), strict=True))
    if not sum(t for _, t, _, _ in about):
        nothing = F.array().cast(EVIDENCE)
        return rows.select("doc_id", "text_hash", "held_out", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"), nothing.alias("evidence")), found
    flat = lambda c: entries.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False)
    sizes = np.array([len(x) for x in entries.column("ids")])
    weight = (np.log((1 + n_docs) / (1 + df)) + 1) * boost
    # built once and here, so that workers hold the index alone and not what it is made from
    index = Examples(arranged(about, flat("ids"), flat("counts"), sizes, weight, boost > 1), weight, math.log(1 + n_docs) + 1, k)
    del entries
    sent, mark = docs.sparkSession.sparkContext.broadcast(index), uuid.uuid4().hex
    del index
    lists = lambda part, c: [x.values.to_numpy() for x in part.column(c)]

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        all_ = held(("toxicity", mark), lambda: sent.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                got = all_.votes(lists(part, "ids"), lists(part, "counts"), [0.0] * part.num_rows, [all_.place[h] for h in part.column("text_hash").to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column("text_hash"), pa.array([v for v, _, _ in got], pa.float64())], names=["text_hash", "vote"])

    # an example is known by its text: rows may share a doc_id, and rows of equal texts have equal vectors
    firsts = docs.sparkSession.createDataFrame([(d, h) for d, _, _, h in about], "doc_id bigint, text_hash bigint")
    once = found.join(F.broadcast(firsts), ["doc_id", "text_hash"]).dropDuplicates(["text_hash"]).select("text_hash", "ids", "counts")
    got = once.mapInArrow(own, "text_hash bigint, vote double").toArrow().sort_by("text_hash")
    label = {h: t / (t + c) for _, t, c, h in about}
    a, b = calibration(got.column("vote").to_numpy(), np.array([label[h] for h in got.column("text_hash").to_pylist()]), np.ones(got.num_rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        all_ = held(("toxicity", mark), lambda: sent.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                got = all_.votes(lists(part, "ids"), lists(part, "counts"), part.column("rest").to_pylist())
                scores = [1 / (1 + math.exp(-min(30.0, max(-30.0, a * math.log(v / (1 - v)) + b)))) for v, _, _ in got]
                near, edges = np.concatenate([n for _, n, _ in got]), np.cumsum([0, *(len(n) for _, n, _ in got)], dtype=np.int32)
                doc, toxic, clean = (pa.array(x[near]) for x in all_.members)
                evidence = pa.ListArray.from_arrays(pa.array(edges), pa.StructArray.from_arrays([doc, pa.array(np.concatenate([c for _, _, c in got])), toxic, clean], fields=list(ITEM)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text_hash"), part.column("held_out"), pa.array(scores, pa.float64()), pa.array([int(x >= 0.5) for x in scores], pa.int32()), evidence],
                    names=["doc_id", "text_hash", "held_out", "score", "predicted", "evidence"])

    return rows.mapInArrow(run, schema), found


def reject_toxic(docs: DataFrame, labels: DataFrame, k: int = 15, per_class: int = 10_000, max_terms: int = 2_000) -> DataFrame:
    """Rows of docs, all columns, whose doc_id and text are not predicted toxic by score_toxicity."""
    scored, vectors_ = _scored(docs, labels, k, per_class, max_terms)
    gone = stored(scored.filter("predicted = 1").select("doc_id", "text_hash").distinct(), "tox-gone")
    discard(vectors_)
    # most rows are certainly not among them and stay where they were read
    maybe, rest = parted(docs, F.xxhash64(F.col("doc_id").cast("long"), F.xxhash64("text")), gone.select(F.xxhash64("doc_id", "text_hash").alias("key")))
    return rest.unionByName(maybe.join(gone, maybe["doc_id"].eqNullSafe(gone["doc_id"]) & F.xxhash64(maybe["text"]).eqNullSafe(gone["text_hash"]), "left_anti"))
