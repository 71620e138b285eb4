"""Language-model scoring by online logistic context mixing over running text.

A text is coded bit by bit. Frequent words have a binary code by their counts; each of its bits is
predicted under hashed contexts: none, the last very frequent word (which tells the language), the
word before, the two words before. Other words are an escape, then their bytes, whose bits
are predicted under hashed contexts of 1 to 6 bytes and of that frequent word. The predictions
are mixed in the logistic domain by weights that a gate selects, and a map, learnt like
the weights, refines the mix. The counts under all contexts and the weights come from all training text.

Two memories of the whole corpus, joined by Spark, stand beside the mix: counts of rare
words, and counts of phrases (runs of words between places that the words themselves set).
Each is interpolated by the share of what training text had already seen. A training text is scored
by what all others teach, as a text that is held out is: its own counts are taken off.
"""

from __future__ import annotations

import heapq
import uuid
from collections import Counter
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import held, most_frequent, stored

#: Bits of the size of each predictor's table: under words (none, last frequent word, word before, two before) and under bytes (contexts of ORDERS, frequent word with 2 bytes).
TABLES = ((18, 19, 19, 18), (17, 17, 17, 18, 18, 18))
ORDERS = (1, 2, 3, 4, 6)
#: Sets of weights of either kind, places on the map, and counts added to both outcomes.
GATES, BUCKETS, PRIOR = 32, 33, 0.4
#: Logistic predictions are kept as multiples of this, in one byte each, so that tables stay in a processor's cache.
STEP = 1 / 12
#: Steps in which weights and map are learnt, each from an equal share of the training texts; the pull of weights to their start, and of the map, in bits.
STEPS, PULL, MAP_PULL = 3, 1.0, 50.0
#: Words with codes, and the most bytes of one; others are spelled.
HEAD, LONGEST = 200_000, 64
#: Very frequent words, the last of which is a context.
LATEST = 256
#: A phrase starts where the hash of the REACH words before is divisible by PHRASE, and has at most LIMIT words.
REACH, PHRASE, LIMIT = 3, 16, 64
#: Distinct words that a task counts before it hands them on.
HELD = 200_000
#: Bytes of text that are worked on at once, and slots of tables that are handed on together.
SLICE, BLOCK = 1 << 18, 1024

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _M2
    return h ^ (h >> np.uint64(29))


def _slot(h: np.ndarray, bits: int) -> np.ndarray:
    return (h >> np.uint64(64 - bits)).astype(np.int64)


def held_out(doc_id: Column, folds: int = 10) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == 0, F.lit(False))


def tokens(text: str | None) -> list[bytes]:
    """Words of the whole text: ASCII letters lower-cased, split at ASCII blanks."""
    return text.encode().lower().split() if text else []


def word_hash(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word)


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows of batch(text, ...) in turn, about SLICE bytes of text at a time."""
    ends = np.cumsum([len(t or "") + 64 for t in batch.column("text").to_pylist()]) // SLICE
    at = 0
    for to in [*np.nonzero(ends[1:] != ends[:-1])[0] + 1, batch.num_rows] if batch.num_rows else ():
        yield batch.slice(at, to - at)
        at = to


def count_words(docs: DataFrame) -> DataFrame:
    """word, c (in rows that are not held out) for all words of docs(text, held_out); the row of the null word counts documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        documents = 0

        def out() -> pa.RecordBatch:
            got = pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["word", "c"])
            seen.clear()
            return got

        for batch in batches:
            for text, away in zip(batch.column("text").to_pylist(), batch.column("held_out").to_pylist(), strict=True):
                if away:  # the words are listed, but count nothing
                    seen.update(dict.fromkeys(tokens(text), 0))
                else:
                    seen.update(tokens(text))
                    documents += 1
                if len(seen) >= HELD:
                    yield out()
        yield out()
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.binary()), pa.array([documents])], names=["word", "c"])

    return docs.mapInArrow(run, "word binary, c bigint").groupBy("word").agg(F.sum("c").alias("c"))


class Code:
    """Binary codes, by counts, of words, of the end (the last but one) and of the escape (the last).

    Symbols go by falling count. Of symbol i, bit d is bits[starts[i] + d], taken at node nodes[starts[i] + d].
    """

    def __init__(self, words: list[bytes], counts: list[int], ends: int, escapes: int):
        self.mark = uuid.uuid4().hex
        order = sorted(range(len(words)), key=lambda i: (-counts[i], words[i]))
        self.words = [words[i] for i in order]
        self.counts = np.array([counts[i] for i in order], dtype=np.int64)
        self.end, self.escape = len(words), len(words) + 1
        weights = [*(int(c) for c in self.counts), ends, escapes]
        self.weights = np.array(weights, dtype=np.int64)
        heap = [(w, i) for i, w in enumerate(weights)]
        heapq.heapify(heap)
        n = len(weights)
        parent, side = np.zeros(2 * n - 1, dtype=np.int64), np.zeros(2 * n - 1, dtype=bool)
        for inner in range(n, 2 * n - 1):
            (a, i), (b, j) = heapq.heappop(heap), heapq.heappop(heap)
            parent[[i, j]], side[j] = inner, True
            heapq.heappush(heap, (a + b, inner))
        # from the root down, each node's depth, then all symbols' paths at once from the leaves up
        depth = np.zeros(2 * n - 1, dtype=np.int64)
        for i in range(2 * n - 3, -1, -1):
            depth[i] = depth[parent[i]] + 1
        self.lengths = depth[:n]
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.nodes, self.bits = np.zeros(self.lengths.sum(), dtype=np.int32), np.zeros(self.lengths.sum(), dtype=bool)
        at, symbol = np.arange(n), np.arange(n)
        while len(at):
            place = self.starts[symbol] + depth[at] - 1
            self.nodes[place], self.bits[place] = parent[at] - n, side[at]
            at = parent[at]
            up = depth[at] > 0
            at, symbol = at[up], symbol[up]


class Reader:
    """What reading texts with a Code needs besides: numbers and hashes of words."""

    def __init__(self, code: Code):
        self.code = code
        self.number = {w: i for i, w in enumerate(code.words)}
        self.hashes = np.array([*map(word_hash, code.words), 1, 2], dtype=np.uint64)
        # along all paths: twice the node plus the bit, and twice a hash of the node plus the bit
        self.plain = code.nodes * 2 + code.bits
        self.mixed = (_slot(_mix(code.nodes.astype(np.uint64) * _M1 + np.uint64(5)), 18) * 2 + code.bits).astype(np.int32)


_BYTE = np.arange(256)
#: Per bit and byte: the bit, and a hash of the bits before it, doubled, and the bit.
_OUTCOME = np.array([(_BYTE >> (7 - j)) & 1 for j in range(8)], dtype=bool)
_PREFIX = np.array([_slot(_mix(((1 << j) | (_BYTE >> (8 - j))).astype(np.uint64) * _M1), 17) * 2 + _OUTCOME[j] for j in range(8)])


class Stream:
    """Texts as symbols, each text with an end before it (which is not coded) and after it."""

    def __init__(self, lists: list[list[bytes]], reader: Reader):
        code, self.reader = reader.code, reader
        self.sizes = np.array([len(x) for x in lists], dtype=np.int64)
        first = np.cumsum(self.sizes + 2) - self.sizes - 2
        ids = np.full(int((self.sizes + 2).sum()), code.end, dtype=np.int64)
        self.doc = np.repeat(np.arange(len(lists)), self.sizes + 2)
        coded = np.ones(len(ids), dtype=bool)
        coded[first] = False
        inner = coded.copy()
        inner[first + self.sizes + 1] = False
        ids[inner] = np.fromiter(map(reader.number.get, chain.from_iterable(lists), repeat(code.escape)), dtype=np.int64, count=int(self.sizes.sum()))
        self.ids, self.coded, self.first, self.inner = ids, coded, first, inner
        self.rare = np.nonzero(ids == code.escape)[0]  # places of words that are spelled
        place = np.full(len(ids), -1)
        place[inner] = np.arange(int(self.sizes.sum()))
        flat = list(chain.from_iterable(lists))
        self.spelled = [flat[i] for i in place[self.rare]]
        # the last very frequent word before each place
        start = ~coded
        seen = np.maximum.accumulate(np.where((ids < LATEST) | start, np.arange(len(ids)), 0))
        latest = np.where(start, LATEST, ids)[seen]
        self.latest = np.concatenate([[LATEST], latest[:-1]])

    def hashes(self) -> np.ndarray:
        """64-bit hashes of the words at all places."""
        h = self.reader.hashes[self.ids]
        h[self.rare] = np.fromiter(map(word_hash, self.spelled), dtype=np.uint64, count=len(self.spelled))
        return h

    def events(self) -> Iterator[tuple[int, int, np.ndarray, list[np.ndarray], np.ndarray]]:
        """Bits by kind (0: of codes, 1: of bytes) and gate: kind, gate, outcomes, twice the slot plus the outcome for each predictor, and places of their words."""
        code, reader = self.reader.code, self.reader
        at = np.nonzero(self.coded)[0]
        lengths = code.lengths[self.ids[at]]
        # the longest codes first, so that those that have a bit d are a beginning of all
        order = np.argsort(-lengths, kind="stable")
        at = at[order]
        one, two = np.roll(self.ids, 1).astype(np.uint64), np.roll(self.ids, 2).astype(np.uint64)
        contexts = (self.latest[at].astype(np.uint64), one[at], one[at] + (two[at] << np.uint64(32)))
        hashed = [_slot(_mix(x * _M1 + np.uint64(k)), bits) * 2 for k, (bits, x) in enumerate(zip(TABLES[0][1:], contexts, strict=True))]
        starts, left = code.starts[self.ids[at]], np.searchsorted(-lengths[order], -np.arange(lengths.max()))
        for d, n in enumerate(left.tolist()):
            for a in range(0, n, 1 << 15):
                these = slice(a, min(n, a + (1 << 15)))
                path = starts[these] + d
                plain, mixed = reader.plain[path], reader.mixed[path]
                yield 0, min(d, GATES - 1), (plain & 1).astype(bool), [plain, *(h[these] ^ mixed for h in hashed)], at[these]
        if not self.spelled:
            return
        flat = np.frombuffer(b" ".join(self.spelled) + b" ", dtype=np.uint8)
        lengths = np.fromiter(map(len, self.spelled), dtype=np.int64, count=len(self.spelled)) + 1
        word = np.repeat(np.arange(len(lengths)), lengths)
        inside = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        before, contexts = np.zeros(len(flat), dtype=np.uint64), []
        for back in range(1, max(ORDERS) + 1):
            before[back:] |= np.where(inside[back:] >= back, flat[:-back], 0).astype(np.uint64) << np.uint64(8 * back - 8)
            if back in ORDERS:
                contexts.append(_slot(_mix((before + np.uint64(back)) * _M1), TABLES[1][len(contexts)]) * 2)
            if back == 2:
                spoken = _slot(_mix((before + (self.latest[self.rare][word].astype(np.uint64) << np.uint64(20))) * _M1 + np.uint64(9)), TABLES[1][-1]) * 2
        contexts.append(spoken)
        for k in range(4):
            for part in np.array_split(own := np.nonzero(np.minimum(inside, 3) == k)[0], max(1, len(own) >> 15)):
                these, byte = [c[part] for c in contexts], flat[part]
                for j in range(8):
                    prefix = _PREFIX[j][byte]
                    yield 1, k * 8 + j, _OUTCOME[j][byte], [c ^ prefix for c in these], self.rare[word[part]]


_EDGES = [np.cumsum([0, *(1 << b for b in bits)]) for bits in TABLES]
#: Slots of all tables.
SLOTS = int(_EDGES[0][-1] + _EDGES[1][-1])


def _tables(flat: np.ndarray) -> list[list[np.ndarray]]:
    """Each kind's tables as parts of one array, in which each slot has a number for each outcome."""
    base = (0, int(_EDGES[0][-1]))
    return [[flat[2 * (base[k] + a) : 2 * (base[k] + b)] for a, b in zip(e[:-1], e[1:], strict=True)] for k, e in enumerate(_EDGES)]


class Mixer:
    """Weights per kind and gate, and the map that refines the mix."""

    def __init__(self) -> None:
        self.start = [np.full((GATES, len(bits)), 1.5 / len(bits)) for bits in TABLES]
        self.weights = [w.copy() for w in self.start]
        self.map = np.tile(1 / (1 + np.exp(-np.linspace(-8, 8, BUCKETS))), (2, GATES, 1))

    @staticmethod
    def stretched(counts: np.ndarray, left_out: bool = False) -> np.ndarray:
        """Logistic predictions of counts(slot, outcome), two per slot; left_out: with one mark of outcome 0 or 1 taken off."""
        n0, n1 = counts[:, 0].astype(np.float32), counts[:, 1].astype(np.float32)
        ratio = lambda zeros, ones: np.clip(np.rint(np.log((ones + np.float32(PRIOR)) / (zeros + np.float32(PRIOR))) / np.float32(STEP)), -127, 127).astype(np.int8)
        off = int(left_out)
        return np.stack([ratio(np.maximum(n0 - off, 0), n1), ratio(n0, np.maximum(n1 - off, 0))], axis=1).ravel()

    @staticmethod
    def _inputs(tables: list[np.ndarray], slots: list[np.ndarray]) -> np.ndarray:
        x = np.empty((len(slots), len(slots[0])), dtype=np.float32)
        for row, table, s in zip(x, tables, slots, strict=True):
            np.multiply(table.take(s), np.float32(STEP), out=row)
        return x

    def _mixed(self, kind: int, gate: int, x: np.ndarray) -> np.ndarray:
        return np.clip(self.weights[kind][gate].astype(np.float32) @ x, -8, 8)

    def sums(self, stream: Stream, tables: list[list[np.ndarray]], total: list[np.ndarray], last: bool) -> None:
        """Add to total, per kind and gate: gradient and curvature of the weights, or, in the last step, per place on the map bits and ones."""
        for kind, gate, y, slots, _ in stream.events():
            x = self._inputs(tables[kind], slots)
            mixed, n = self._mixed(kind, gate, x), len(x)
            row = total[kind][gate]
            if last:
                place = np.rint((mixed + 8) * 2).astype(np.int64)
                row[-2 * BUCKETS : -BUCKETS] += np.bincount(place, minlength=BUCKETS)
                row[-BUCKETS:] += np.bincount(place[y], minlength=BUCKETS)
            else:
                p = 1 / (1 + np.exp(-mixed))
                row[:n] += x @ (y - p)
                row[n : n + n * n] += ((x * (p * (1 - p))) @ x.T).ravel()

    @staticmethod
    def nothing() -> list[np.ndarray]:
        return [np.zeros((GATES, len(bits) + len(bits) ** 2 + 2 * BUCKETS)) for bits in TABLES]

    def step(self, total: list[np.ndarray], last: bool) -> None:
        """A Newton step of the weights; in the last step the map, under weights that stay."""
        for kind, bits in enumerate(TABLES):
            n, t = len(bits), total[kind]
            if last:
                hits, ones = t[:, -2 * BUCKETS : -BUCKETS], t[:, -BUCKETS:]
                self.map[kind] = np.round((ones + MAP_PULL * self.map[kind]) / (hits + MAP_PULL), 6)
                continue
            curve = t[:, n : n + n * n].reshape(GATES, n, n) + PULL * np.eye(n)
            off = self.weights[kind] - self.start[kind]
            change = np.linalg.solve(curve, (t[:, :n] - PULL * off)[..., None])[..., 0]
            # rounded, so that the order in which tasks are summed does not show
            self.weights[kind] = np.round(self.weights[kind] + np.clip(change, -1, 1), 4)

    def log10(self, stream: Stream, tables: list[list[np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        """log10 of the probability of each place's symbol, and of each spelled word's bytes."""
        out = np.ones((2, len(stream.ids)))
        for kind, gate, y, slots, at in stream.events():
            mixed = self._mixed(kind, gate, self._inputs(tables[kind], slots))
            place = np.rint((mixed + 8) * 2).astype(np.int64)
            p1 = np.clip((1 / (1 + np.exp(-mixed)) + self.map[kind][gate].astype(np.float32)[place]) / 2, 1e-6, 1 - 1e-6)
            p = np.where(y, p1, 1 - p1)
            if kind == 0:
                out[0][at] *= p  # each place once in an event, at most some 40 times
            else:
                out[1] += np.bincount(at, np.log10(p), minlength=len(out[1]))
        return np.log10(out[0]), out[1][stream.rare] - 1


def _reader(sent: object) -> Reader:
    """Kept in the worker from task to task."""
    return held(("lm", sent.value.mark), lambda: Reader(sent.value))


def context_counts(docs: DataFrame, sent: object) -> np.ndarray:
    """Outcomes under each hashed context over all texts of docs(text): (slot, outcome). Tasks hand on their tables in blocks, which are summed as they come."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, total = _reader(sent), np.zeros(SLOTS * 2, dtype=np.int32)
        parts = _tables(total)
        waiting: list[list[list[np.ndarray]]] = [[[] for _ in bits] for bits in TABLES]
        held_now = 0

        def add() -> None:
            for kind, tables in enumerate(parts):
                for k, table in enumerate(tables):
                    if waiting[kind][k]:
                        np.add(table, np.bincount(np.concatenate(waiting[kind][k]), minlength=len(table)), out=table, casting="unsafe")
                        waiting[kind][k].clear()

        for batch in batches:
            for part in slices(batch):
                for kind, _, y, slots, _ in Stream([tokens(t) for t in part.column("text").to_pylist()], reader).events():
                    for k, s in enumerate(slots):
                        if kind or k:  # what the codes have without context follows from the counts of words
                            waiting[kind][k].append(s.astype(np.int32))
                    held_now += len(y)
                    if held_now > 1 << 22:
                        add()
                        held_now = 0
        add()
        blocks = total.reshape(-1, BLOCK * 2)
        used = np.nonzero(blocks.any(axis=1))[0]
        for at in range(0, len(used), 256):
            some = used[at : at + 256]
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array([b.tobytes() for b in blocks[some]], pa.binary())], names=["block", "counts"])

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, c in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                c = np.frombuffer(c, dtype=np.int32)
                total[k] = total[k] + c if k in total else c.astype(np.int64)
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array([c.astype(np.float32).tobytes() for c in total.values()], pa.binary())], names=["block", "counts"])

    schema = "block bigint, counts binary"
    got = docs.select("text").mapInArrow(count, schema).repartition("block").mapInArrow(add_up, schema).toArrow()
    counts = np.zeros((SLOTS // BLOCK, BLOCK * 2), dtype=np.float32)
    for k, c in zip(got.column("block").to_pylist(), got.column("counts").to_pylist(), strict=True):
        counts[k] = np.frombuffer(c, dtype=np.float32)
    code = sent.value
    counts.ravel()[: 2 << TABLES[0][0]] = np.bincount(code.nodes * 2 + code.bits, np.repeat(code.weights, code.lengths), minlength=2 << TABLES[0][0])
    return counts.reshape(-1, 2)


def learn(docs: DataFrame, sent: object, counts: np.ndarray, steps: int = STEPS) -> Mixer:
    """Weights and map from all texts of docs(text), each in one of the steps, by the hash of the text: tasks sum over their bits, Spark over the tasks."""
    mixer, spark = Mixer(), docs.sparkSession
    tables = spark.sparkContext.broadcast(Mixer.stretched(counts, left_out=True))
    for k in range(steps):

        def run(batches: Iterator[pa.RecordBatch], mixer: Mixer = mixer, last: bool = k == steps - 1) -> Iterator[pa.RecordBatch]:
            reader, total, parts = _reader(sent), Mixer.nothing(), _tables(tables.value)
            for batch in batches:
                for part in slices(batch):
                    mixer.sums(Stream([tokens(t) for t in part.column("text").to_pylist()], reader), parts, total, last)
            flat = np.concatenate([t.ravel() for t in total])
            used = np.nonzero(flat)[0]
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(flat[used])], names=["place", "v"])

        own = docs.filter(F.pmod(F.xxhash64("text"), F.lit(steps)) == k).select("text")
        got = own.mapInArrow(run, "place bigint, v double").groupBy("place").agg(F.sum("v").alias("v")).toArrow()
        total = Mixer.nothing()
        flat = np.zeros(sum(t.size for t in total))
        flat[got.column("place").to_numpy()] = got.column("v").to_numpy()
        mixer.step([x.reshape(t.shape) for x, t in zip(np.split(flat, [total[0].size]), total, strict=True)], last=k == steps - 1)
    tables.unpersist()
    return mixer


def phrases(stream: Stream) -> tuple[np.ndarray, np.ndarray]:
    """The phrases that all words and ends of the texts are cut into: number per place (-1 before a text), and a hash each.

    Where a phrase starts depends on the words before it in its text and on nothing else, and it
    ends where the next starts, so that no phrase is the beginning of another.
    """
    h = stream.hashes()
    n = np.arange(len(h))
    since = n - np.repeat(stream.first, stream.sizes + 2)
    before = np.zeros(len(h), dtype=np.uint64)
    for back in range(1, REACH + 1):
        before[back:] = _mix(before[back:] + h[:-back] * _M1 * np.uint64(2 * back + 1))
    starts = (since == 1) | stream.coded & (since > REACH) & (before % np.uint64(PHRASE) == 0)
    last = np.maximum.accumulate(np.where(starts, n, 0))
    starts |= stream.coded & ((n - last) % LIMIT == 0)
    last = np.maximum.accumulate(np.where(starts, n, 0))
    number = np.where(stream.coded, np.cumsum(starts) - 1, -1)
    place = _mix(h + (n - last).astype(np.uint64) * _M1)
    heads = np.nonzero(starts)[0]
    # what precedes a text is no part of its last phrase
    sums = np.add.reduceat(np.where(stream.coded, place, np.uint64(0)), heads) if len(heads) else np.empty(0, np.uint64)
    return number, _mix(sums + np.uint64(11))


def _earlier(doc: np.ndarray, key: np.ndarray, taught: bool) -> np.ndarray:
    """How often each key came before in its document, less how often it is there at all if the documents taught."""
    order = np.lexsort((key, doc))
    d, k = doc[order], key[order]
    first = np.concatenate([[True], (d[1:] != d[:-1]) | (k[1:] != k[:-1])])[: len(d)]
    at = np.arange(len(d))
    run = np.cumsum(first) - 1
    starts = at[first]
    sizes = np.diff(np.concatenate([starts, [len(d)]]))
    out = np.empty(len(d), dtype=np.int64)
    out[order] = at - starts[run] - (sizes[run] if taught else 0) if len(d) else 0
    return out


def read_texts(docs: DataFrame, sent: object, counts: np.ndarray, mixer: Mixer, below: float) -> DataFrame:
    """Per row of docs(doc_id, text, held_out), what its words with codes say, and rare words and phrases to be looked up.

    row, doc_id, held_out, n_tokens, n_bytes, known, base; rare: (phrase, h, said, spelled); phrases: (phrase, h, said, p).
    """
    send = docs.sparkSession.sparkContext.broadcast
    tables, others = send(Mixer.stretched(counts)), send(Mixer.stretched(counts, left_out=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        reader, parts = _reader(sent), {False: _tables(tables.value), True: _tables(others.value)}
        code = reader.code
        base = np.log10((np.concatenate([code.counts, [0, 0]]) + 0.1) / below)
        row = TaskContext.get().partitionId() << 36

        def nested(doc: np.ndarray, n: int, **fields: pa.Array) -> pa.Array:
            return pa.ListArray.from_arrays(pa.array(np.searchsorted(doc, np.arange(n + 1)), pa.int32()), pa.StructArray.from_arrays(list(fields.values()), names=list(fields)))

        for batch in batches:
            for part, teaches in ((some, t) for part in slices(batch) for t in (True, False) if (some := part.filter(pc.equal(part.column("held_out"), not t))).num_rows):
                lists = [tokens(t) for t in part.column("text").to_pylist()]
                s, n = Stream(lists, reader), len(lists)
                p, spelled = mixer.log10(s, parts[teaches])
                number, keys = phrases(s)
                firsts = number[s.first + 1]
                sums = np.bincount(number[s.coded], p[s.coded], minlength=len(keys))
                of = np.repeat(np.arange(n), np.diff(np.concatenate([firsts, [len(keys)]])))
                coded = s.inner & (s.ids < code.end)
                count = lambda v=None: np.bincount(s.doc[coded], v, minlength=n)  # noqa: E731, B023
                rare_keys = s.hashes()[s.rare]
                said = _earlier(s.doc[s.rare], rare_keys, teaches), _earlier(of, keys, teaches)
                phrase = lambda k, d: pa.array((k - firsts[d]).astype(np.int32))  # noqa: E731, B023
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row + np.arange(n)), part.column("doc_id"), part.column("held_out"), pa.array(s.sizes + 1), pa.array(np.array([sum(map(len, x)) + len(x) for x in lists], dtype=np.int64)),
                     pa.array(count().astype(np.int64)), pa.array(count(base[s.ids[coded]]).astype(float)),
                     nested(s.doc[s.rare], n, phrase=phrase(number[s.rare], s.doc[s.rare]), h=pa.array(rare_keys.view(np.int64)), said=pa.array(said[0]), p=pa.array(spelled)),
                     nested(of, n, phrase=phrase(np.arange(len(keys)), of), h=pa.array(keys.view(np.int64)), said=pa.array(said[1]), p=pa.array(sums))],
                    names=["row", "doc_id", "held_out", "n_tokens", "n_bytes", "known", "base", "rare", "phrases"])
                row += n

    item = "array<struct<phrase:int,h:bigint,said:bigint,p:double>>"
    return docs.select("doc_id", "text", "held_out").mapInArrow(run, f"row bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_bytes bigint, known bigint, base double, rare {item}, phrases {item}")


def score_texts(docs: DataFrame, head: int = HEAD) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte for every row of docs(doc_id, text).

    Rows with crc32(doc_id as text) mod 10 = 0 are held out, all others teach (also
    those with a null doc_id). A text's tokens are its words, ASCII letters lower-cased, and
    one end; null or empty text is the end alone. base_score sums log10((c + 0.1) / (N + 0.1
    (V + 1))) over the tokens. score is the model's log10 probability of the token
    sequence, in this order: the probabilities of all sequences sum to at most 1. A text that
    taught is scored by what the others taught: its rare words and phrases are taken off their counts, and each bit's own mark off its contexts. bits_per_byte is the
    same per byte of what is coded, the lower-cased words with one blank or end after each; null for a text without words. Repeated rows are scored each for itself;
    an empty table gives no rows. Other columns are ignored. Rare words and phrases are told apart by 64-bit hashes.
    """
    if head + 2 > 1 << TABLES[0][0]:
        raise ValueError("the table of nodes has no room for so many words")
    spark = docs.sparkSession
    marked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out(F.col("doc_id")).alias("held_out"))
    counted = stored(count_words(marked.select("text", "held_out")), "lm-words")
    words = counted.filter("word IS NOT NULL")
    totals = counted.agg(F.sum("c").alias("n"), F.sum(F.when(F.col("word").isNull(), F.col("c"))).alias("ends"), F.count(F.when(F.col("word").isNotNull() & (F.col("c") > 0), 1)).alias("types"),
                         F.count(F.when(F.col("word").isNotNull() & (F.col("c") == 1), 1)).alias("single")).first()
    n, ends = totals["n"] or 0, totals["ends"] or 0
    below = float(n + 0.1 * (totals["types"] + (ends > 0) + 1))
    # words that occur once are always spelled, so that the escape is as likely as words that are new
    best = most_frequent(words.withColumnRenamed("c", "whole").filter((F.col("whole") > 1) & (F.octet_length("word") <= LONGEST)), head).toArrow()
    rare = n - ends - int(np.sum(best.column("whole").to_numpy()))
    code = Code(best.column("word").to_pylist(), best.column("whole").to_pylist(), ends, rare)
    sent = spark.sparkContext.broadcast(code)
    taught = marked.filter(~F.col("held_out"))
    counts = context_counts(taught, sent)
    mixer = learn(taught, sent, counts)
    read = stored(read_texts(marked, sent, counts, mixer, below), "lm-read")

    hashed = words.select(F.col("word"), "c").mapInArrow(_hashed, "h bigint, c bigint")
    phrase_counts = read.filter(~F.col("held_out")).select(F.explode("phrases.h").alias("h")).groupBy("h").agg(F.count("*").alias("c"))
    phrase_counts = stored(phrase_counts, "lm-phrases")
    of_phrases = phrase_counts.agg(F.sum("c").alias("n"), F.count(F.when(F.col("c") == 1, 1)).alias("single")).first()
    share = lambda single, of: min(0.999, max(0.001, 1 - (single + 1) / (of + 2)))
    known = [(rare, share(totals["single"], rare)), (of_phrases["n"] or 0, share(of_phrases["single"], of_phrases["n"] or 0))]

    # rare words and phrases look up their counts in one join; phrases that occur once are not worth a look
    there = hashed.withColumn("kind", F.lit(0)).unionByName(phrase_counts.withColumn("kind", F.lit(1)))
    asked = [read.select("row", "held_out", F.lit(kind).alias("kind"), F.inline(column)) for kind, column in enumerate(("rare", "phrases"))]
    found = asked[0].unionByName(asked[1]).join(there, ["h", "kind"], "left").select("row", "kind", "phrase", "p", "c", F.greatest(F.coalesce("c", F.lit(0)) + F.col("said"), F.lit(0)).cast("double").alias("seen"))

    def mixed(p: Column, kind: int) -> Column:
        of, lam = known[kind]
        return F.log10((1 - lam) * F.pow(F.lit(10.0), p) + lam * F.col("seen") / float(max(of, 1)))

    new = lambda kind: float(np.log10(1 - known[kind][1])) + F.col("p")
    found = found.withColumn("p", F.when((F.col("kind") == 0) & (F.col("seen") > 0), mixed(F.col("p"), 0)).when(F.col("kind") == 0, new(0)).otherwise(F.col("p")))
    parts = found.repartition("row").groupBy("row", "phrase").agg(
        F.sum("p").alias("p"), F.max(F.when(F.col("kind") == 1, F.col("seen"))).alias("seen"), F.count(F.when((F.col("kind") == 0) & (F.col("c") > 0), 1)).alias("known"),
        F.sum(F.when(F.col("kind") == 0, F.log10((F.coalesce("c", F.lit(0)) + 0.1) / below))).alias("base"))
    parts = parts.groupBy("row").agg(F.sum(F.when(F.col("seen") > 0, mixed(F.col("p"), 1)).otherwise(new(1))).alias("score"), F.sum("known").alias("r_known"), F.sum("base").alias("r_base"))
    end = float(np.log10((ends + 0.1) / below))
    return read.drop("rare", "phrases").join(parts, "row").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.col("r_known") + int(ends > 0)).cast("long").alias("n_known"), F.lit(int(n)).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("r_base", F.lit(0.0)) + end).alias("base_score"), "score", F.when(F.col("n_bytes") > 0, -F.col("score") / float(np.log10(2)) / (F.col("n_bytes") + 1)).alias("bits_per_byte"))


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        h = np.fromiter(map(word_hash, batch.column("word").to_pylist()), dtype=np.uint64, count=batch.num_rows)
        yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), batch.column("c")], names=["h", "c"])
