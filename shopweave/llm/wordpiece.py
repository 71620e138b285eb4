"""Token counts of greedy longest-match word pieces, without building the pieces.

The vocabulary is a trie. Where matching stops in the midst of a token, the
failure link leads to the state in which matching goes on, and a count says how many
pieces were given off on the way; both are computed once for each state. A word is
then read once, symbol by symbol.
"""

from __future__ import annotations

import base64
from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .shared import Remembered, held

#: Words that a worker remembers.
REMEMBERED = 300_000


class PieceCounter:
    """Counts greedy pieces over a vocabulary of byte strings that holds every single byte."""

    def __init__(self, vocabulary: Iterable[bytes]):
        self.next: list[dict[int, int]] = [{}]
        token = [False]
        for word in vocabulary:
            at = 0
            for b in word:
                to = self.next[at].get(b)
                if to is None:
                    to = self.next[at][b] = len(self.next)
                    self.next.append({})
                    token.append(False)
                at = to
            token[at] = True
        if len(self.next[0]) < 256 or not all(token[v] for v in self.next[0].values()):
            raise ValueError("the vocabulary lacks a single byte")
        n = len(self.next)
        self.fail, self.popped = [0] * n, [0] * n
        queue = deque([(0, b, v) for b, v in self.next[0].items()])
        while queue:
            parent, b, v = queue.popleft()
            if token[v]:  # the whole path is one piece
                self.fail[v], self.popped[v] = 0, 1
            else:
                at, count = self.fail[parent], self.popped[parent]
                while b not in self.next[at]:
                    count += self.popped[at]
                    at = self.fail[at]
                self.fail[v], self.popped[v] = self.next[at][b], count
            queue.extend((v, c, w) for c, w in self.next[v].items())
        self.words = Remembered(lambda word: self.count(b" " + word), REMEMBERED)

    def count(self, word: bytes) -> int:
        nxt, fail, popped = self.next, self.fail, self.popped
        at = total = 0
        for b in word:
            while b not in nxt[at]:
                total += popped[at]
                at = fail[at]
            at = nxt[at][b]
        while at:
            total += popped[at]
            at = fail[at]
        return total


def load(path: str) -> PieceCounter:
    """From a file of base64 tokens and ranks."""

    def make() -> PieceCounter:
        with open(path, "rb") as f:
            return PieceCounter(base64.b64decode(line.split()[0]) for line in f if line.strip())

    return held(("wordpiece", path), make)


def count_tokens(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """df without its text, and n_bytes, n_words, n_tokens of each whole text.

    Words are runs of anything but ASCII blanks, read with one space before; pieces
    are the longest vocabulary matches from left to right. Null or empty text: zeros.
    Columns of df with these three names are replaced.
    """
    new = ("n_bytes", "n_words", "n_tokens")
    kept = [f for f in df.schema.fields if f.name not in (*new, text)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = load(path)
        for batch in batches:
            rows = [(len(b), len(w := b.split()), sum(map(counter.words.__getitem__, w))) for b in ((t or "").encode() for t in batch.column(len(kept)).to_pylist())]
            cols = [*batch.columns[: len(kept)]] + [pa.array([r[k] for r in rows], pa.int64()) for k in range(3)]
            yield pa.RecordBatch.from_arrays(cols, names=[*(f.name for f in kept), *new])

    return df.select(*[df[f.name] for f in kept], df[text]).mapInArrow(
        run, T.StructType([*kept, *(T.StructField(n, T.LongType()) for n in new)]))
