"""BPE encoding by backtracking over longest matches, and decoding by an offset table.

Every prefix of a correct BPE result is itself the correct result for the text it
covers, and a token may follow another only if BPE leaves the two apart when they
stand alone. So the encoder takes the longest vocabulary match at each place (all
found in one Aho-Corasick pass), checks it against the token before, and steps
back to shorter matches where the check fails. Each place is ruled out at most once,
so the work is linear in the word's length.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import Remembered, held

#: White space of the normalizer; Python's own str.split also splits on \x1c-\x1f.
_SPACE = r"\t-\r \x85\xa0  -     　"
_ODD = regex.compile("[\x1c-\x1f]")
_SPLIT = regex.compile(f"[{_SPACE}]+")
#: Words and pairs that a worker remembers.
REMEMBERED = 100_000
#: Rows handled at a time, so that no step holds more than a few MB beyond its batch.
SLICE = 128


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: printable Latin-1 stays, the rest follow from 256 on."""
    keep = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in keep else next(spare)) for b in range(256)]


class WordBpe:
    """The vocabulary and merges of a tokenizer file whose BPE marks word ends."""

    #: Added to the code of a word's last symbol.
    LAST = 0xE000

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, self.suffix = spec["model"], spec["model"]["end_of_word_suffix"]
        self.symbols = byte_symbols()
        self._byte_of = dict(enumerate(self.symbols))
        vocab = model["vocab"]
        names = self.symbols + [s + self.suffix for s in self.symbols]
        texts = [*self.symbols, *(chr(ord(s) + self.LAST) for s in self.symbols)]
        base = len(names)
        # tokens are numbered in the order in which merges make them: single symbols, then by rank
        number = {n: i for i, n in enumerate(names)}
        self.left, self.right, self.merge = [-1] * base, [-1] * base, {}
        for a, b in model["merges"]:
            x, y = number[a], number[b]
            new = len(names)
            if number.setdefault(a + b, new) != new:
                raise ValueError("two merges make the same token")
            names.append(a + b)
            texts.append(texts[x] + texts[y])
            self.left.append(x)
            self.right.append(y)
            self.merge[x, y] = new
        self.base = base
        self.id_bytes = [np.int32(vocab[n]).tobytes() for n in names]
        self.length = [len(t) for t in texts]
        known = {t: i for i, t in enumerate(texts)}
        self.shorter = [next((known[t[:k]] for k in range(len(t) - 1, 0, -1) if t[:k] in known), -1) for t in texts]
        self.automaton = ahocorasick.Automaton()
        for t, i in known.items():
            self.automaton.add_word(t, i)
        self.automaton.make_automaton()
        self.pairs: dict[tuple[int, int], bool] = {}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self._pieces = regex.compile(pattern.replace(r"\s", _SPACE))
        self.words = Remembered(self._word, REMEMBERED)
        # the offset table: all token names one after another, and where each starts
        table = {**{i: n for n, i in vocab.items()}, **{i: n for n, i in self.special.items()}}
        coded = [table.get(i, "").encode() + b" " for i in range(max(table) + 1)]
        self.pool = np.frombuffer(b"".join(coded), dtype=np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum([len(c) for c in coded])])

    def compatible(self, a: int, b: int) -> bool:
        """Whether BPE leaves the tokens a and b apart when they stand side by side.

        Undoes the merges of both, the latest first, and looks at the two symbols that
        touch: had a merge joined them before either went into its parent, the
        border would be gone. Of equal merges the left one comes first.
        """
        u, v, up_u, up_v = a, b, 1 << 30, 1 << 30
        result = True
        while True:
            joined = self.merge.get((u, v))
            if joined is not None and joined < up_u and joined <= up_v:
                result = False
                break
            if u < self.base and v < self.base:
                break
            if u > v:
                up_u, u = u, self.right[u]
            else:
                up_v, v = v, self.left[v]
        if len(self.pairs) >= REMEMBERED:
            self.pairs.clear()
        self.pairs[a, b] = result
        return result

    def encode_piece(self, piece: str) -> list[int]:
        """Token numbers of one piece, a non-empty word or run of marks."""
        s = piece.encode().decode("latin-1").translate(self._byte_of)
        s = s[:-1] + chr(ord(s[-1]) + self.LAST)
        n = len(s)
        length, shorter, pairs = self.length, self.shorter, self.pairs
        longest = [-1] * n
        for end, token in self.automaton.iter(s):  # of those that start at one place, the longest ends last
            longest[end - length[token] + 1] = token
        ruled_out: set[int] = set()
        out: list[int] = []
        at, token, before = 0, longest[0], -1
        while at < n:
            while token >= 0:
                if at + length[token] not in ruled_out:
                    if before < 0:
                        break
                    fits = pairs.get((before, token))
                    if fits or fits is None and self.compatible(before, token):
                        break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                at += length[token]
                before = token
                if at < n:
                    token = longest[at]
            else:  # nothing fits here: rule this place out and try a shorter token before it
                ruled_out.add(at)
                at -= length[before]
                token = shorter[out.pop()]
                before = out[-1] if out else -1
        return out

    def _word(self, word: str) -> bytes:
        """Ids of a text without white space, as the bytes of an int32 array."""
        if not word.isascii():
            word = unicodedata.normalize("NFC", word).replace("Σ", "σ")  # no final form of sigma
        word = word.lower()
        # letters only are one piece, whatever the pattern's other parts
        tokens = self.encode_piece(word) if word.isalpha() else chain.from_iterable(map(self.encode_piece, self._pieces.findall(word)))
        return b"".join(map(self.id_bytes.__getitem__, tokens))

    def encode(self, text: str) -> bytes:
        """Ids of a text as the bytes of an int32 array; special tokens in the text keep their ids."""
        if self._special and any(t in text for t in self.special):
            parts = self._special.split(text)
            return b"".join(np.int32(self.special[p]).tobytes() if k % 2 else self.encode_plain(p) for k, p in enumerate(parts))
        return self.encode_plain(text)

    def encode_plain(self, text: str) -> bytes:
        words = filter(None, _SPLIT.split(text)) if _ODD.search(text) else text.split()
        return b"".join(map(self.words.__getitem__, words))

    def decode_batch(self, ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all texts and their n + 1 offsets; ids of text k are ids[ends[k]:ends[k + 1]], names are joined by one space."""
        starts = self.offsets[ids]
        sizes = self.offsets[ids + 1] - starts
        at = np.concatenate([[0], np.cumsum(sizes)])
        where = np.repeat(starts - at[:-1], sizes) + np.arange(at[-1])
        got = self.pool[where]
        stops = at[ends]
        keep = np.ones(len(got), dtype=bool)
        full = ends[1:] > ends[:-1]
        keep[stops[1:][full] - 1] = False  # the space after each text's last token
        return got[keep], stops - np.concatenate([[0], np.cumsum(full)])


def load(path: str) -> WordBpe:
    return held(("bpe", path), lambda: WordBpe(path))


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            yield batch.slice(at, SLICE)


def _with(batch: pa.RecordBatch, name: str, array: pa.Array) -> pa.RecordBatch:
    cols = {n: batch.column(n) for n in batch.schema.names if n != name}
    return pa.RecordBatch.from_arrays([*cols.values(), array], names=[*cols, name])


def _ends(sizes: list[int] | np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def _decoded(bpe: WordBpe, ids: np.ndarray, ends: np.ndarray) -> pa.Array:
    data, offsets = bpe.decode_batch(ids, ends)
    return pa.LargeStringArray.from_buffers(len(ends) - 1, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)).cast(pa.string())


def encode(df: DataFrame, path: str, text: str = "text", out: str = "ids", decoded: str | None = None) -> DataFrame:
    """df and the ids of each whole text as array<int> in out; null counts as empty, which gives no ids.

    decoded names one more column for the text that the ids decode to, made in the same
    pass. Columns of df with these names are replaced.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in _sliced(batches):
            got = [bpe.encode(t) if t else b"" for t in batch.column(text).to_pylist()]
            ends = _ends([len(g) // 4 for g in got])
            ids = np.frombuffer(b"".join(got), dtype=np.int32)
            result = _with(batch, out, pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids)))
            yield _with(result, decoded, _decoded(bpe, ids, ends)) if decoded else result

    new = [T.StructField(out, T.ArrayType(T.IntegerType())), *([T.StructField(decoded, T.StringType())] if decoded else [])]
    return df.mapInArrow(run, T.StructType([*(f for f in df.schema.fields if f.name not in (out, decoded)), *new]))


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """df and the text of each array of ids in out: token names joined by one space, special ones kept; null or no ids give the empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in _sliced(batches):
            col = batch.column(ids)
            ends = _ends(pa.compute.fill_null(pa.compute.list_value_length(col), 0).to_numpy(zero_copy_only=False))
            yield _with(batch, out, _decoded(bpe, pa.compute.list_flatten(col).to_numpy(zero_copy_only=False), ends))

    fields = [f for f in df.schema.fields if f.name != out]
    return df.mapInArrow(run, T.StructType([*fields, T.StructField(out, T.StringType())]))


def ids_digest(ids: str) -> Column:
    """sha256, lowercase hex, of the decimal ids joined by one space."""
    return F.sha2(F.array_join(F.col(ids).cast("array<string>"), " "), 256)
