"""Large regions of the Jaccard join are taken apart before their sets meet."""

import numpy as np
import pytest

from shopweave.llm import jaccard

SETS = "region bigint, fp bigint, n bigint, hashes binary"


def as_rows(sets):
    return [(1, i, len(s), np.sort(s).tobytes()) for i, s in enumerate(sets)]


def test_large_regions_of_unrelated_sets_are_taken_apart(spark, monkeypatch):
    rng = np.random.default_rng(3)
    fresh = lambda n: rng.integers(0, 1 << 63, n, dtype=np.uint64)
    chain = fresh(501)
    # each shares one shingle with the set before and one with the next
    sets = [np.concatenate([fresh(18), chain[i : i + 2]]) for i in range(500)]
    sets[7] = np.concatenate([sets[450][:19], fresh(1)])
    df = spark.createDataFrame(as_rows(sets), SETS)
    assert {r["fp"] for r in jaccard.apart(df, 90).collect()} == {7, 450}
    monkeypatch.setattr(jaccard, "join_large", lambda *a: pytest.fail("unrelated sets meet each other"))
    assert [sorted(r) for r in jaccard.join_all(df, 90).collect()] == [[7, 450]]


@pytest.mark.parametrize("percent", [67, 80, 90])
def test_sets_taken_apart_are_not_linked(spark, percent):
    rng = np.random.default_rng(percent)
    reach, pool = jaccard.Reach(percent), rng.integers(0, 1 << 63, 90, dtype=np.uint64)
    base = [rng.permutation(pool)[: rng.integers(3, 50)] for _ in range(25)]
    sets = []
    for _ in range(200):
        own = rng.permutation(base[rng.integers(25)])
        sets.append(np.unique(np.concatenate([own[rng.integers(0, 2 + len(own) // 8) :], rng.choice(pool, rng.integers(0, 3))])))
    region = {r["fp"]: r["region"] for r in jaccard.apart(spark.createDataFrame(as_rows(sets), SETS), percent).collect()}
    linked = 0
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            both = len(np.intersect1d(a, b))
            if both < len(a) + len(b) - both and reach.linked(both, len(a), len(b)):  # equal sets are one set in the join
                linked += 1
                assert i in region and region[i] == region[j]
    assert linked > 30
