"""A trained part-of-speech tagger with lemmas: a hidden Markov model whose counts Spark makes, with the best path found sentence by sentence."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopweave.operators.places import stored
from shopweave.session import require

START = ""
MAX_TAGS = 64


def sentences(texts: DataFrame) -> DataFrame:
    """doc_id, sent (from 0), words of texts(doc_id, text): one row a sentence that has words; null texts have none."""
    parts = texts.select("doc_id", F.posexplode(F.split("text", r"[.!?\n]+")).alias("sent", "part"))
    return parts.select("doc_id", "sent", F.filter(F.split("part", r"[^\p{L}]+"), lambda w: w != "").alias("words")).filter(F.size("words") > 0)


def mark(word: Column, at: Column) -> Column:
    """? for the first word of a sentence (its capital says nothing), ^ for one with a capital, _ for one without."""
    return F.when(at == 0, "?").when(word.rlike(r"^\p{Lu}"), "^").otherwise("_")


def keys_of(words: Column) -> Column:
    """Each word in lower case behind its mark."""
    return F.transform(words, lambda w, i: F.concat(mark(w, i), F.lower(w)))


def _endings(word: Column, longest: int) -> Column:
    return F.transform(F.filter(F.sequence(F.lit(0), F.lit(longest)), lambda k: k <= F.length(word)), lambda k: F.concat(F.lit("~"), F.right(word, k)))


def _score(n: Column, total: Column, add: float, base: Column) -> Column:
    """Logarithms in whole thousandths, so that paths are compared exactly."""
    return F.floor(1000 * F.log((n + F.lit(add)) / (total + base)))


@dataclass(frozen=True)
class Tagger:
    """tags in order; moves[(tag before, tag)] and heads (whole words '=', endings '~', behind their mark) in thousandths of a logarithm;
    rules: letters to cut and to add for tag and whole word or ending. All are bounded by the parameters of train_tagger."""

    tags: list[str]
    moves: np.ndarray
    heads: dict[str, np.ndarray]
    rules: dict[str, tuple[int, str]]
    ending: int

    def head(self, key: str) -> str | None:
        """What tells a word's tags: itself where known, else its longest known ending."""
        mark, word = key[0], key[1:]
        tries = [f"{mark}={word}", *(f"{mark}~{word[len(word) - k:]}" for k in range(min(self.ending, len(word)), -1, -1))]
        return next((t for t in tries if t in self.heads), None)

    def emissions(self, keys: list[str]) -> np.ndarray:
        """Scores of the words' tags, a row a word; of words without a head all are 0."""
        heads = [self.head(k) for k in keys]
        return np.array([np.zeros(len(self.tags), np.int64) if h is None else self.heads[h] for h in heads], np.int64).reshape(len(keys), len(self.tags))

    def paths(self, emissions: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The best sequences of tags (Viterbi) of sentences of these sizes, whose words' scores stand one after the other; of equal
        ones those with the smaller tag, from the last word back. All sentences take their i-th step together, longer ones first."""
        firsts, longest = np.cumsum(sizes) - sizes, int(sizes.max(initial=0))
        order = np.argsort(-sizes, kind="stable")
        firsts, live = firsts[order], np.searchsorted(-sizes[order], -np.arange(longest), side="left")
        score, back, out = self.moves[0] + emissions[firsts], np.zeros(emissions.shape, np.int8), np.empty(len(emissions), np.int8)
        for i in range(1, longest):
            n, at = live[i], firsts[: live[i]] + i
            reach = score[:n, :, None] + self.moves[1:]
            back[at] = best = reach.argmax(axis=1)
            score[:n] = np.take_along_axis(reach, best[:, None, :], axis=1)[:, 0] + emissions[at]
        tag = score.argmax(axis=1)
        for i in range(longest - 1, -1, -1):
            n, at = live[i], firsts[: live[i]] + i
            out[at] = tag[:n]
            tag[:n] = back[at, tag[:n]]
        return out

    def path(self, keys: list[str]) -> list[int]:
        """The best sequence of tags of one sentence."""
        return self.paths(self.emissions(keys), np.array([len(keys)])).tolist()

    def packed(self) -> tuple:
        """The tables as few large values, which go to workers much faster than many small arrays."""
        cuts, adds = zip(*self.rules.values(), strict=True) if self.rules else ((), ())
        return self.tags, self.moves, list(self.heads), np.array(list(self.heads.values()), np.int64), list(self.rules), list(cuts), list(adds), self.ending

    @staticmethod
    def unpacked(tags: list[str], moves: np.ndarray, heads: list[str], scores: np.ndarray, rules: list[str], cuts: list[int], adds: list[str], ending: int) -> Tagger:
        return Tagger(tags, moves, dict(zip(heads, scores, strict=True)), dict(zip(rules, zip(cuts, adds, strict=True), strict=True)), ending)

    def lemma(self, tag: str, word: str) -> str:
        tries = [f"{tag}={word}", *(f"{tag}~{word[len(word) - k:]}" for k in range(min(self.ending, len(word)), -1, -1))]
        cut, add = next((self.rules[t] for t in tries if t in self.rules), (0, ""))
        return word[: len(word) - cut] + add if cut <= len(word) else word


def train_tagger(tagged: DataFrame, words: int = 100_000, endings: int = 50_000, ending: int = 4) -> Tagger:
    """A Tagger from tagged(words, tags, lemmas): one row a sentence, three arrays of the same length.

    Every row is counted, in one pass over tagged; the model keeps the
    `words` most frequent whole words and the `endings` most frequent endings (of up to `ending`
    letters, counted once a word and tag), ties to the smaller text. Other words are tagged by
    their ending. Rows with a null array, or arrays of different lengths, teach nothing; words
    with a null tag neither, null lemmas count as the word. No rows: ValueError, as with more than 64 tags.
    """
    require(tagged, "words", "tags", "lemmas")
    spark = tagged.sparkSession
    # One value a sentence, so that arrays that are computed are computed once. The array of tags before is longer by one: its last row has no tag.
    off = F.abs(F.size("words") - F.size("tags")) + F.abs(F.size("words") - F.size("lemmas"))
    zipped = F.arrays_zip(F.concat(F.array(F.lit(START)), F.col("tags")).alias("before"), F.col("words").alias("word"), F.col("tags").alias("tag"), F.col("lemmas").alias("lemma"))
    tokens = tagged.select(F.when(off == 0, zipped).alias("z")).select(F.posexplode_outer("z").alias("at", "t")).select("at", "t.*").filter("tag IS NOT NULL")
    each = stored(tokens.groupBy("before", "tag", F.lower("word").alias("word"), F.lower(F.coalesce("lemma", "word")).alias("lemma"), mark(F.col("word"), F.col("at")).alias("mark")).agg(F.count("*").alias("n")), "tokens")
    counts = each.filter("word IS NOT NULL").groupBy("tag", "word", "lemma", "mark").agg(F.sum("n").alias("n")).persist()
    totals = {r["tag"]: r["n"] for r in counts.groupBy("tag").agg(F.sum("n").alias("n")).limit(MAX_TAGS + 1).collect()}
    if not 0 < len(totals) <= MAX_TAGS:
        raise ValueError(f"a tagger needs 1 to {MAX_TAGS} tags, found {'none' if not totals else 'more'}")
    tags = sorted(totals)
    number = {t: i for i, t in enumerate(tags)}

    # A word first in its sentence is known by all places; elsewhere by places with the same mark.
    marks = F.explode(F.when(F.col("mark") == "?", F.array(F.lit("?"))).otherwise(F.array(F.lit("?"), F.col("mark")))).alias("mark")
    seen = counts.select("tag", "word", "n", marks)
    whole = seen.select(F.concat("mark", F.lit("="), "word").alias("key"), "tag", "n")
    types = seen.select("tag", "word", "mark").distinct()
    parts = types.select("tag", "mark", F.explode(_endings(F.col("word"), ending)).alias("e")).select(F.concat("mark", "e").alias("key"), "tag", F.lit(1).cast("bigint").alias("n"))
    type_totals = {r["tag"]: r["n"] for r in counts.select("tag", "word").distinct().groupBy("tag").agg(F.count("*").alias("n")).collect()}
    heads: dict[str, np.ndarray] = {}
    for table, keep, total in ((whole, words, totals), (parts, endings, type_totals)):
        by_tag = [F.sum(F.when(F.col("tag") == t, F.col("n")).otherwise(0)) for t in tags]
        scores = F.array(*[_score(n, F.lit(total[t]), 0.01, F.lit(1)) for n, t in zip(by_tag, tags)])
        kept = table.groupBy("key").agg(F.sum("n").alias("n"), scores.alias("s")).orderBy(F.desc("n"), "key").limit(keep)
        heads |= {r["key"]: np.array(r["s"], np.int64) for r in kept.collect()}

    moved = {(r["before"], r["tag"]): r["n"] for r in each.filter("before IS NOT NULL").groupBy("before", "tag").agg(F.sum("n").alias("n")).collect()}
    grid = [(a, b, moved.get((a, b), 0), sum(moved.get((a, t), 0) for t in tags)) for a in (START, *tags) for b in tags]
    scored = spark.createDataFrame(grid, "a string, b string, n bigint, total bigint").select("a", "b", _score(F.col("n"), F.col("total"), 1.0, F.lit(len(tags))).alias("s"))
    moves = np.zeros((len(tags) + 1, len(tags)), np.int64)
    for r in scored.collect():
        moves[0 if r["a"] == START else number[r["a"]] + 1, number[r["b"]]] = r["s"]

    same = F.size(F.filter(F.sequence(F.lit(0), F.least(F.length("word"), F.length("lemma"))), lambda i: F.left(F.col("word"), i) == F.left(F.col("lemma"), i))) - 1
    rule = counts.groupBy("tag", "word", "lemma").agg(F.sum("n").alias("n")).select("tag", "word", "n", (F.length("word") - same).alias("cut"), F.col("lemma").substr(same + 1, F.length("lemma")).alias("add"))
    by_word = rule.select(F.concat("tag", F.lit("="), "word").alias("key"), "n", "cut", "add")
    by_end = rule.select("tag", F.explode(_endings(F.col("word"), ending)).alias("e"), "cut", "add").select(F.concat("tag", "e").alias("key"), F.lit(1).cast("bigint").alias("n"), "cut", "add")
    rules: dict[str, tuple[int, str]] = {}
    for table, keep in ((by_word, words), (by_end, endings)):
        each = table.groupBy("key", "cut", "add").agg(F.sum("n").alias("n"))
        best = each.groupBy("key").agg(F.sum("n").alias("n"), F.min(F.struct((-F.col("n")).alias("m"), "cut", "add")).alias("best"))
        rules |= {r["key"]: (r["cut"], r["add"]) for r in best.orderBy(F.desc("n"), "key").limit(keep).select("key", "best.cut", "best.add").collect()}
    counts.unpersist()
    return Tagger(tags, moves, heads, rules, ending)


def tag_sentences(texts: DataFrame, model: Tagger) -> DataFrame:
    """doc_id, sent, pos (from 0), word, upos, lemma (lower case) of texts(doc_id, text), a row a word.

    No shuffle: a sentence is a row from where its text is read. The model is broadcast once and unpacked once a task. In
    an Arrow batch each different word is looked up once, and each different pair of tag and word gets its lemma once.
    Words that the model's tables lack get the best tag their ending and neighbours allow.
    """
    shared = texts.sparkSession.sparkContext.broadcast(model.packed())

    @F.arrow_udf("array<struct<upos:string,lemma:string>>")
    def tag(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = Tagger.unpacked(*shared.value)
        for batch in batches:
            sizes = pc.list_value_length(batch).to_numpy(zero_copy_only=False).astype(np.int64)
            encoded = batch.flatten().dictionary_encode()
            keys, of = encoded.dictionary.to_pylist(), encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            tags = m.paths(m.emissions(keys)[of], sizes).astype(np.int64)
            pairs, which = np.unique(tags * max(1, len(keys)) + of, return_inverse=True)
            lemmas = pa.array([m.lemma(m.tags[p // len(keys)], keys[p % len(keys)][1:]) for p in pairs.tolist()], pa.string())
            words = pa.StructArray.from_arrays([pa.array(m.tags, pa.string()).take(pa.array(tags)), lemmas.take(pa.array(which.ravel()))], names=["upos", "lemma"])
            yield pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), words)

    tagged = sentences(texts).withColumn("tagged", tag(keys_of(F.col("words"))))
    rows = tagged.select("doc_id", "sent", F.posexplode(F.arrays_zip(F.col("words").alias("word"), F.col("tagged").alias("tagged"))).alias("pos", "t"))
    return rows.select("doc_id", "sent", "pos", F.col("t.word").alias("word"), "t.tagged.upos", "t.tagged.lemma")
