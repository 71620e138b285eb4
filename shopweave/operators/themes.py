"""Themes of reviews: nouns by rating group, weighted by TF-IDF."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopweave.operators.places import stored

# Words that are no themes. A shop adds its own name.
STOP_WORDS = ("schuh", "frist", "juli", "kontaktformular")
CRITICAL, POSITIVE = "Kritisch (1-3)", "Positiv (4-5)"


def capitalised_words(texts: DataFrame) -> DataFrame:
    """doc_id, word, upos, lemma of texts(doc_id, text): a rule for German, where nouns begin with a capital. Texts must not be lower-cased before."""
    words = texts.select("doc_id", F.explode(F.split("text", r"[^\p{L}]+")).alias("word")).filter("word <> ''")
    return words.withColumns({"upos": F.when(F.col("word").rlike(r"^\p{Lu}"), "NOUN").otherwise("X"), "lemma": F.col("word")})


def tf_idf(counts: DataFrame, doc: str, term: str, n: str) -> DataFrame:
    """counts with tf (n in its document's sum), idf (ln of documents in documents with the term) and tf_idf.

    Sums per document and per term are aggregated and joined back, so no document's terms
    need to fit into one task.
    """
    totals = counts.groupBy(F.col(doc).alias("__d")).agg(F.sum(n).alias("__all"))
    spread = counts.groupBy(F.col(term).alias("__t")).agg(F.count_distinct(doc).alias("__in"))
    documents = totals.agg(F.count("*").alias("__docs"))
    out = counts.join(totals, F.col(doc).eqNullSafe(F.col("__d"))).join(spread, F.col(term).eqNullSafe(F.col("__t"))).crossJoin(documents)
    out = out.withColumns({"tf": F.col(n) / F.col("__all"), "idf": F.log(F.col("__docs") / F.col("__in"))})
    return out.withColumn("tf_idf", F.col("tf") * F.col("idf")).drop("__d", "__all", "__t", "__in", "__docs")


def top_k_per_group(df: DataFrame, group: str, order: list, k: int) -> DataFrame:
    """The first k rows of each group in the given order, which should be total; Spark keeps k a task before it shuffles."""
    return df.withColumn("__rank", F.row_number().over(Window.partitionBy(group).orderBy(*order))).filter(F.col("__rank") <= k).drop("__rank")


def theme_counts(reviews: DataFrame, tagger: Callable[[DataFrame], DataFrame] = capitalised_words, stop_words: tuple[str, ...] = STOP_WORDS) -> DataFrame:
    """rating_group, word, n: nouns of German reviews with stars, as a stored table: TF-IDF reads it three times, and texts should be tagged once. Reviews without title or text have no text."""
    prepared = reviews.filter((F.col("language") == "de") & F.col("stars").isNotNull()).select(
        F.col("id").alias("doc_id"), F.when(F.col("stars") <= 3, CRITICAL).otherwise(POSITIVE).alias("rating_group"), F.concat("title", F.lit(" "), "text").alias("text"))
    nouns = tagger(prepared.select("doc_id", "text")).filter(F.col("upos").isin("NOUN", "PROPN")).select("doc_id", F.lower("lemma").alias("word"))
    grouped = nouns.filter(~F.col("word").isin(*stop_words)).join(prepared.select("doc_id", "rating_group"), "doc_id", "left")
    return stored(grouped.groupBy("rating_group", "word").agg(F.count("*").alias("n")), "themes")


def noun_themes(reviews: DataFrame, tagger: Callable[[DataFrame], DataFrame] = capitalised_words, top_n: int = 10, stop_words: tuple[str, ...] = STOP_WORDS) -> DataFrame:
    """The top_n words of critical and of positive reviews by TF-IDF, then count, then word.

    tagger turns (doc_id, text) into (doc_id, word, upos, lemma); a language model goes in
    by mapInPandas or mapInArrow, loaded once per worker.
    """
    order = [F.desc("tf_idf"), F.desc("n"), F.col("word")]
    return top_k_per_group(tf_idf(theme_counts(reviews, tagger, stop_words), "rating_group", "word", "n"), "rating_group", order, top_n).orderBy("rating_group", *order)
