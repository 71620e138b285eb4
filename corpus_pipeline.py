"""From documents to token ids: toxic texts go, near copies go, sources are mixed, the rest is encoded.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before kept;
every result is written to the shared folder and read again, so an executor that is lost
costs only the stage at hand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopweave.llm import bpe, jaccard, mixing, toxicity
from shopweave.llm.queries import tokenizer_file
from shopweave.llm.shared import read, stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that their nearest labelled examples call toxic go."""
    return toxicity.reject_toxic(docs, read(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by a similarity of 0.8 on 5-word shingles, one row stays, that of the smallest doc_id."""
    return jaccard.keep_one_row(docs, words=5, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's share asks for: never, once or twice."""
    return mixing.repeat_documents(docs, mixing.mix_sources(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids, and digests of the ids and of the text decoded from them."""
    path = tokenizer_file("word_bpe_49k.json")
    done = bpe.encode(docs.select("doc_id", "lang", "source", "text"), path, decoded="decoded")
    return done.select(
        "doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", bpe.ids_digest("ids").alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("toxicity", drop_toxic), ("n-gram Jaccard join", drop_near_copies), ("mixing", mix), ("BPE", encode)]

#: SQL can't express the stages; tests/llm hold run() against a plain Python version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents in sf_dir."""
    docs = read(spark, sf_dir, "documents")
    for n, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"stage{n + 1}")
    return docs
