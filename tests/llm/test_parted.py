"""What keeps the pipeline's joins in proportion to the input: how many keys sets have, and which documents are shuffled."""

import random

import numpy as np
import pyarrow as pa

import corpus_pipeline
from shopweave.llm import jaccard, shared, toxicity


def test_sets_compare_as_many_parts_as_their_partners_need():
    for percent in (67, 80, 90):
        reach, keys, sizes = jaccard.Reach(percent), 0, 0
        for n in range(jaccard.SHORT, 900):
            mine = {c: (parts, compared) for c, parts, compared in reach.classes(n)}
            keys, sizes = keys + sum(x for _, x in mine.values()), sizes + n
            for m in range(n, min(900, 100 * n // percent + 1)):
                if reach.linked(np.int64(n), n, m):
                    c, parts, compared = reach.classes(m)[0]
                    assert mine[c][0] == parts and min(mine[c][1], compared) > reach.differing(n + m) and compared <= parts
        if percent == 80:
            assert keys < 0.6 * sizes


def test_few_documents_are_shuffled(spark, monkeypatch):
    rng = random.Random(2)
    rows = [(i, " ".join(f"w{rng.randrange(5000)}" for _ in range(30))) for i in range(600)]
    rows += [(1000 + i, rows[i][1]) for i in range(5)] + [(7, rows[7][1])]
    seen = []

    def parted(*args):
        seen.append(shared.parted(*args))
        return seen[-1]

    monkeypatch.setattr(jaccard, "parted", parted)
    monkeypatch.setattr(toxicity, "parted", parted)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted(tuple(r) for r in corpus_pipeline.drop_near_copies(spark, df, "").collect()) == sorted(rows[:600])
    labels = spark.createDataFrame([(i, int(i % 50 == 0)) for i in range(600)], "doc_id bigint, toxic int")
    texts = [(i, (f"vile vile w{i} nasty" if i % 50 == 0 else t)) for i, t in rows[:600]]
    kept = toxicity.reject_toxic(spark.createDataFrame(texts, "doc_id bigint, text string"), labels)
    assert sorted(r["doc_id"] for r in kept.collect()) == [i for i in range(600) if i % 50]
    assert [(maybe.count(), rest.count()) for maybe, rest in seen] == [(7, 599), (12, 588)]


def test_rows_are_parted_by_any_number_of_keys(spark):
    df = spark.range(1000).selectExpr("nullif(id, 3) AS id", "id AS same")
    for keys in ([], [5], [None], list(range(0, 1000, 2))):
        maybe, rest = shared.parted(df, df["id"], spark.createDataFrame(pa.table({"k": pa.array(keys, pa.int64())})))
        got = {r["id"] for r in maybe.collect()}
        assert set(keys) <= got and len(got) <= len(keys) + 3 and maybe.columns == df.columns
        assert sorted(r["same"] for r in maybe.unionByName(rest).collect()) == list(range(1000))
