"""Joins, search, licences, mixing, scoring and toxicity, against brute force and on odd input."""

import collections
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shopweave.llm import components, jaccard, licenses, lm, mixing, queries, topk, toxicity
from shopweave.llm.shared import hashed_share, most_frequent

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, 0) for i, t, s in rows], DOC)


# ---- components and the Jaccard join


def brute(rows, words, percent):
    sets = []
    for i, text in rows:
        t = (text or "").encode().lower().split()
        sets.append((i, {tuple(t[k : k + words]) for k in range(len(t) - words + 1)} if len(t) >= words else {tuple(t)} if t else set()))
    up = list(range(len(sets)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                up[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            least[root(k)] = min(i, least.get(root(k), i))
    return sorted(((i, len(s), least.get(root(k)) if s else i) for k, (i, s) in enumerate(sets)), key=str)


def near_copies(seed, n=160):
    rng = random.Random(seed)
    vocabulary = ["w%d" % k for k in range(300)]
    base = [[rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 4, 9, 10, 11, 19, 40, 90]))] for _ in range(12)]
    rows = []
    for i in range(n):
        t = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
            t[rng.randrange(len(t))] = rng.choice(vocabulary)
        rows.append((i * 3 % n, " ".join(t).upper() if rng.random() < 0.2 else "\t".join(t)))
    return rows + [(900, ""), (901, None), (902, " "), (None, rows[0][1]), (None, "lone null id"), (3, rows[5][1])]


@pytest.mark.parametrize(("words", "percent", "largest"), [(3, 90, 2_000_000), (5, 80, 2_000_000), (3, 90, 300), (5, 80, 300), (2, 67, 400)])
def test_join_equals_brute_force(spark, words, percent, largest):
    rows = near_copies(words)
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, fp int")
    got = [tuple(r) for r in jaccard.jaccard_components(df, words, percent, largest).collect()]
    assert sorted(got, key=str) == brute(rows, words, percent)


def test_join_query_equals_brute_force(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert sorted((tuple(r) for r in queries.op4_jaccard_join(spark, sf_dir).collect()), key=str) == brute(rows, 3, 90)


def test_join_of_nothing_and_long_text(spark):
    assert jaccard.jaccard_components(docs(spark, [])).count() == 0
    long = " ".join(f"w{k % 997}x{k % 1013}" for k in range(60_000))
    got = jaccard.jaccard_components(docs(spark, [(1, long, "a"), (2, long + " end", "a"), (3, "w", "a")])).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {1: 1, 2: 1, 3: 3}


def test_one_row_of_each_group_stays(spark):
    same = "a b c d e f"
    df = docs(spark, [(5, same, "x"), (2, same, "x"), (2, same, "x"), (2, "quite another text that nobody has", "x"), (None, same, "x"), (None, "no id", "x"), (None, "no id", "x"), (7, None, "x"), (5, "only here", "x")])
    got = collections.Counter((r["doc_id"], r["text"]) for r in corpus_pipeline.drop_near_copies(spark, df, "").collect())
    assert got == collections.Counter([(2, same), (2, "quite another text that nobody has"), (None, "no id"), (7, None), (5, "only here")])


def test_linked_sets_share_a_key():
    rng = np.random.default_rng(5)
    for percent in (80, 90):
        reach = jaccard.Reach(percent)
        for n in (4, 5, 8, 11, 20, 27, 55, 60, 63, 64, 70, 96, 200):
            for _ in range(30):
                a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
                gone = rng.integers(0, max(1, n * (100 - percent) // 100) + 1)
                b = np.unique(np.concatenate([a[gone:], rng.integers(0, 1 << 63, rng.integers(0, 3), dtype=np.uint64)]))
                both = len(np.intersect1d(a, b))
                if a.tobytes() != b.tobytes() and 100 * both >= percent * (len(a) + len(b) - both):
                    common = np.sort(rng.choice(a, len(a) // 2, replace=False))
                    assert set(reach.keys(a, common)) & set(reach.keys(b, common)) and set(reach.keys(a, a[:0])) & set(reach.keys(b, a[:0]))


def test_unrelated_short_sets_share_no_region():
    rng = np.random.default_rng(6)
    for percent in (80, 90):
        reach = jaccard.Reach(percent)
        for n in (*range(1, 8), 9, 18, 63, 64, 100):
            keys = np.concatenate([reach.keys(np.unique(rng.integers(0, 1 << 64, n, dtype=np.uint64)), np.empty(0, np.uint64)) for _ in range(20_000 if n < 8 else 3_000)])
            assert len(keys) == 0 or np.unique(keys, return_counts=True)[1].max() <= 3


@pytest.mark.parametrize("percent", [80, 90])
def test_cells_and_windows_link_what_brute_force_links(percent):
    rng, reach = np.random.default_rng(percent), jaccard.Reach(percent)
    visits = pivots = 0
    for _ in range(30):
        base = [np.unique(rng.integers(0, 1 << 63, 60, dtype=np.uint64)) for _ in range(3)]
        sets = [np.unique(np.concatenate([rng.permutation(base[rng.integers(3)])[rng.integers(0, 9) :], rng.integers(0, 1 << 63, rng.integers(0, 9), dtype=np.uint64)])) for _ in range(50)]
        region, plain = jaccard.Region(sets, reach), components.Forest()
        region.join()
        for i, a in enumerate(sets):
            for j in range(i):
                both = len(np.intersect1d(a, sets[j]))
                if 100 * both >= percent * (len(a) + len(sets[j]) - both):
                    plain.join(i, j)
        assert [region.forest.root(i) for i in range(50)] == [plain.root(i) for i in range(50)]
        visits, pivots = visits + region.visits, pivots + len(region.pivots)
    assert visits > 100 and 30 < pivots < 30 * 50  # windows are used, and most sets are no pivots


def test_near_copies_cost_one_distance_each():
    base = np.arange(300, dtype=np.uint64) << np.uint64(40)
    region = jaccard.Region([np.delete(base, [k]) for k in range(200)], jaccard.Reach(90))
    region.join()
    assert (len(region.pivots), region.visits) == (1, 0) and len({region.forest.root(i) for i in range(200)}) == 1


def test_a_crowd_of_near_copies_is_joined_in_chunks(spark):
    rng = random.Random(9)
    base = [f"w{k}" for k in range(80)]
    rows = [(i, " ".join([*base[: (p := rng.randrange(80))], *(f"x{rng.randrange(10**6)}" for _ in range(rng.choice([1, 1, 2, 3]))), *base[p:]])) for i in range(420)]
    rows += [(1000 + i, " ".join([*base[:40], *(f"y{i}z{k}" for k in range(40))])) for i in range(30)] + [(None, rows[3][1])] * 5
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    for words, percent in ((3, 90), (5, 80)):
        got = [tuple(r) for r in jaccard.jaccard_components(df, words, percent).collect()]
        assert sorted(got, key=str) == brute(rows, words, percent)


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, k) for k in range(1001, 1200)] + [(5000, 5000), (2, 1), (-7, 7000)]
    random.Random(1).shuffle(edges)
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a bigint, b bigint").repartition(5)).collect()}
    assert got == {**{i: 0 for i in range(301)}, **{i: 1000 for i in range(1000, 1200)}, -7: -7, 7000: -7}
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# ---- top-k


def test_topk_edges(spark):
    rng = random.Random(2)
    vec = lambda n: [rng.choice([-1.0, -0.5, 0.0, 0.25, 1.0]) for _ in range(n)]
    rows = [(i, vec(3), 0) for i in range(40)] + [(50, vec(2), 0), (51, vec(2), 0), (100, None, 0), (101, [1.0, None, 2.0], 0), (102, [1.0, float("nan"), 1.0], 0), (103, [float("inf")] * 3, 0), (None, vec(3), 0)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, rank int")
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in topk.top_k(df, F.col("vec_id") % 10 == 0, k=5, block=2, shard=7).collect()}
    whole = [(i, [math.floor(256 * x) for x in v]) for i, v, _ in rows if i is not None and i < 100]
    want = {}
    for q, v in whole:
        if q % 10 == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in whole if i != q and len(w) == len(v))[:5]
            want |= {(q, k + 1): (i, -s) for k, (s, i) in enumerate(best)}
    assert got == want
    assert topk.top_k(df.limit(0), F.col("vec_id") % 10 == 0).count() == 0


def test_repeated_ids_and_overflow(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (0, [2.0, 0.0]), (1, [1.0, 1.0]), (1, [1.0, 1.0]), (1, [1.0, 9.0]), (2, [0.5, 0.0]), (3, [0.25, 0.0]), (4, [1e18, 0.0]), (5, [1e30, 1.0]), (6, [-1e17, 3.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    for shard in (2, 100):
        got = [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in topk.top_k(df.repartition(3), F.col("vec_id") % 4 == 0, k=3, shard=shard).collect()]
        assert sorted(got) == [(0, 1, 1, 65536), (0, 2, 2, 32768), (0, 3, 3, 16384)]


def test_merge_tree_and_grid(spark):
    rng = random.Random(5)
    whole = [(i, [rng.randrange(-4, 5) / 4 for _ in range(4)]) for i in range(700)]
    df = spark.createDataFrame(whole, "vec_id bigint, embedding array<double>")
    got = collections.defaultdict(list)
    for r in topk.top_k(df, F.col("vec_id") % 3 == 0, k=5, block=3, shard=8, fan_in=3).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    for q, v in whole[::3]:
        best = sorted((-int(sum(256 * a * 256 * b for a, b in zip(v, w, strict=True))), i) for i, w in whole if i != q)[:5]
        assert got[q] == [(i, -s) for s, i in best]


def test_large_values_are_summed_as_integers(spark):
    df = spark.createDataFrame([(0, [3e6, 1.0]), (1, [3e6, 1 / 256]), (2, [3e6, 2 / 256])], "vec_id bigint, embedding array<double>")
    got = [(r["vec_id"], r["score"]) for r in topk.top_k(df, F.col("vec_id") == 0).collect()]
    big = (256 * 3_000_000) ** 2
    assert got == [(2, big + 512), (1, big + 256)]


# ---- licences


def test_licences(spark):
    rows = [("r/LICENSE", "Released under the MIT License."), ("r/a/x.py", "first second third fourth " * 9 + "\nLicensed under the Apache License, Version 2.0.\nmore code"), ("r/a/y.py", "code only"), ("q/z.py", "the license of this text is free"), ("r/b/c/deep.py", None),
            (None, "Released under the MIT License."), ("top", ""), ("r/a/y.py", "code only")]
    got = [tuple(r) for r in licenses.scan_licenses(spark.createDataFrame(rows, "path string, text string").withColumn("license", F.lit(1))).select("path", "license", "how", "source").collect()]
    assert sorted(got, key=str) == sorted([
        ("r/LICENSE", "MIT", "own", None), ("r/a/x.py", "Apache-2.0", "own", None), ("r/a/y.py", "MIT", "inherited", "r"), ("r/a/y.py", "MIT", "inherited", "r"), ("q/z.py", None, "none", None),
        ("r/b/c/deep.py", "MIT", "inherited", "r"), (None, "MIT", "own", None), ("top", None, "none", None)], key=str)
    assert licenses.scan_licenses(spark.createDataFrame([], "path string, text string")).count() == 0


def test_rows_without_paths_and_repeated_paths(spark):
    mit = "Released under the MIT License."
    rows = [(None, mit), (None, "nothing here at all"), (None, None), ("p/x", mit), ("p/x", "code only"), ("p/y", "code only")]
    got = [tuple(r) for r in licenses.scan_licenses(spark.createDataFrame(rows, "path string, text string")).select("path", "license", "how", "source").collect()]
    assert sorted(got, key=str) == sorted([(None, "MIT", "own", None), (None, None, "none", None), (None, None, "none", None), ("p/x", "MIT", "own", None), ("p/x", "MIT", "inherited", "p"), ("p/y", "MIT", "inherited", "p")], key=str)


def test_whole_licence_texts_and_wrapped_headers(spark):
    import textwrap

    bodies = {n: t for n, t in licenses.TEMPLATES if len(t) > 400}
    rows = [(f"{n}/LICENSE", "\n".join(textwrap.wrap(t.replace("year", "2021").replace("holder", "Jane Doe and others"), 60))) for n, t in bodies.items()]
    rows += [(f"{n}/src/a.py", "value = 1\n") for n in bodies]
    notice = next(t for n, t in licenses.TEMPLATES if n == "LGPL-2.1")
    rows += [("z/wrapped.c", "int main;\n" * 40 + "\n".join("// " + x for x in textwrap.wrap(notice, 80)) + "\nint more;\n" * 40)]
    got = {r["path"]: r for r in licenses.scan_licenses(spark.createDataFrame(rows, "path string, text string")).collect()}
    for n in bodies:
        assert (got[f"{n}/LICENSE"]["license"], got[f"{n}/LICENSE"]["how"]) == (n, "own")
        assert (got[f"{n}/src/a.py"]["license"], got[f"{n}/src/a.py"]["source"]) == (n, n)
    assert (got["z/wrapped.c"]["license"], got["z/wrapped.c"]["how"]) == ("LGPL-2.1", "own")


def test_licences_are_native(spark, sf_dir):
    plan = queries.op7_licenses(spark, sf_dir)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


# ---- mixing


def reshared(sizes, weights, share, most):
    """Targets by resharing again and again."""
    left, total, out = dict(sizes), share * sum(sizes.values()), {}
    while left:
        level = total / sum(weights[s] for s in left)
        over = [s for s in left if level * weights[s] > most * sizes[s]]
        if not over:
            return out | {s: level * weights[s] for s in left}
        for s in over:
            out[s] = most * sizes[s]
            total -= out[s]
            del left[s]
    return out


def test_mixing_meets_targets(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(["w"] * rng.choice([0, 1, 5, 20, 20, 80])), rng.choice(["a", "a", "a", "a", "b", "Z", None])) for i in range(3000)]
    df = docs(spark, rows)
    got = mixing.mix_sources(df).collect()
    assert len(got) == 3000
    sizes = collections.Counter()
    for _, t, s in rows:
        sizes[s] += len(t.split())
    names = sorted((s for s in sizes if s), key=str) + [None]
    target = reshared(sizes, {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}, 1.5, 2.0)
    taken = collections.Counter()
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and math.isclose(r["target"], target[r["source"]])
        assert r["copies"] in (math.floor(r["target"] / r["source_size"]), math.ceil(r["target"] / r["source_size"]))
        assert r["taken"] == r["copies"] * r["size"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    for s in names:
        assert abs(taken[s] - target[s]) <= max(200, 0.02 * target[s])
    key = lambda r: (r["doc_id"], r["taken"])
    assert sorted(map(key, got)) == sorted(map(key, mixing.mix_sources(df.repartition(9)).collect()))


def test_chances_are_kept(spark):
    df = spark.createDataFrame([("s", i, 10, 0.3) for i in range(40)], "source string, doc_id bigint, size bigint, p double")
    runs = [{r["doc_id"]: r["pick"] for r in mixing.pivotal_round(df, seed=s * 100, fan_in=8).collect()} for s in range(12)]
    assert all(len(r) == 40 and sum(r.values()) == 12 for r in runs)  # the number is fixed, who is picked is not
    assert len({tuple(sorted(r.items())) for r in runs}) > 1


def test_mixing_of_odd_tables(spark):
    assert mixing.mix_sources(docs(spark, [])).count() == 0
    rows = [(None, None, None), (1, "", "a"), (1, "x y", "a"), (1, "x y", "a"), (2, "z " * 50_000, "b")]
    df = docs(spark, rows).withColumn("copies", F.lit("mine"))
    mixed = mixing.mix_sources(df)
    assert mixed.count() == 5
    out = mixing.repeat_documents(df, mixed)
    assert out.columns == df.columns and out.filter("copies <> 'mine'").count() == 0
    with pytest.raises(ValueError, match="share"):
        mixing.source_targets(mixed, share=3.0)


def test_rows_without_ids_and_equal_rows(spark):
    rows = [(None, f"w{k} " * 10, "a") for k in range(400)] + [(7, "same words here", "a")] * 400 + [(7, f"other {k}", "a") for k in range(200)] + [(k, "x " * 8, "b") for k in range(300)]
    df = docs(spark, rows)
    mixed = mixing.mix_sources(df)
    got = mixed.collect()
    assert len(got) == len(rows)
    size = {"a": 400 * 10 + 1200 + 400, "b": 2400}
    target = reshared(size, {"a": 5, "b": 2}, 1.5, 2.0)
    out = mixing.repeat_documents(df, mixed).collect()
    for s in size:
        words = sum(len(r["text"].split()) for r in out if r["source"] == s)
        assert words == sum(r["taken"] for r in got if r["source"] == s) and abs(words - target[s]) <= 30
    often = collections.Counter((r["doc_id"], r["text"]) for r in out)
    rate = target["a"] / size["a"]
    assert all(math.floor(rate) * n <= often[i, t] <= math.ceil(rate) * n for (i, t), n in collections.Counter((i, t) for i, t, s in rows if s == "a").items())


def test_very_many_equal_rows_are_rounded_quickly(spark):
    import time

    df = spark.range(100_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("s").alias("source"), F.when(F.col("id") < 0, "").otherwise("a b c").alias("text"))
    df = df.unionByName(spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("t").alias("source"), F.lit("d e").alias("text")))
    start = time.time()
    got = {r["source"]: (r["n"], r["taken"], r["target"]) for r in mixing.mix_sources(df).groupBy("source").agg(F.count("*").alias("n"), F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()}
    assert time.time() - start < 60 and got["s"][0] == 100_000 and abs(got["s"][1] - got["s"][2]) <= 3


def test_mixing_is_native(spark, sf_dir):
    plan = queries.op8_mixing(spark, sf_dir)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


# ---- language model


def plain_scores(spark, rows):
    """score of each row by plain Python: the same code, contexts, steps and memories, one bit at a time."""
    M, words = (1 << 64) - 1, lambda t: (t or "").encode().lower().split()

    def mix(h):
        h = ((h & M) ^ (h & M) >> 31) * 0xBF58476D1CE4E5B9 & M
        return h ^ h >> 29

    slot = lambda h, bits: h >> 64 - bits
    m1 = 0x9E3779B97F4A7C15
    taught = [not (i is not None and zlib.crc32(str(i).encode()) % 10 == 0) for i, _ in rows]
    c = collections.Counter(w for t, (_, x) in zip(taught, rows, strict=True) if t for w in words(x))
    head = {w: n for w, n in c.items() if n > 1 and len(w) <= lm.LONGEST}
    rare = sum(c.values()) - sum(head.values())
    code = lm.Code(list(head), list(head.values()), sum(taught), rare)
    number = {w: i for i, w in enumerate(code.words)}

    def bits(text):
        """kind, gate, slots, outcome, place of the word."""
        ids = [code.end, *(number.get(w, code.escape) for w in words(text)), code.end]
        latest = lm.LATEST
        for i in range(1, len(ids)):
            s, one, two = ids[i], ids[i - 1], ids[i - 2] if i > 1 else code.end
            for d in range(code.lengths[s]):
                node = int(code.nodes[code.starts[s] + d])
                h = slot(mix(node * m1 + 5), 18)
                yield 0, min(d, lm.GATES - 1), [node, slot(mix(latest * m1), 19) ^ h, slot(mix(one * m1 + 1), 19) ^ h, slot(mix((one + (two << 32)) * m1 + 2), 18) ^ h], bool(code.bits[code.starts[s] + d]), i
            if s == code.escape:
                w = words(text)[i - 1] + b" "
                for t, byte in enumerate(w):
                    before = lambda k, w=w, t=t: sum(w[t - b] << 8 * b - 8 for b in range(1, min(k, t) + 1))
                    own = [slot(mix((before(k) + k) * m1), size) for k, size in zip(lm.ORDERS, lm.TABLES[1], strict=False)] + [slot(mix((before(2) + (latest << 20)) * m1 + 9), lm.TABLES[1][-1])]
                    for j in range(8):
                        prefix = slot(mix((1 << j | byte >> 8 - j) * m1), 17)
                        yield 1, min(t, 3) * 8 + j, [x ^ prefix for x in own], bool(byte >> 7 - j & 1), i
            latest = s if s < lm.LATEST else latest

    counts = collections.Counter((kind, k, s, y) for t, (_, x) in zip(taught, rows, strict=True) if t for kind, _, ss, y, _ in bits(x) for k, s in enumerate(ss))

    def inputs(kind, slots, y, left_out):
        n = [[counts[kind, k, s, v] - (left_out and v == y) for v in (0, 1)] for k, s in enumerate(slots)]
        return [max(-127, min(127, round(math.log((b + lm.PRIOR) / (a + lm.PRIOR)) / lm.STEP))) * lm.STEP for a, b in n]

    mixer = lm.Mixer()
    fold = [r["k"] for r in spark.createDataFrame([(k, t) for k, (_, t) in enumerate(rows)], "n int, text string").select("n", F.pmod(F.xxhash64("text"), F.lit(lm.STEPS)).alias("k")).orderBy("n").collect()]
    for step in range(lm.STEPS):
        total = mixer.nothing()
        for t, f, (_, text) in zip(taught, fold, rows, strict=True):
            for kind, gate, slots, y, _ in bits(text) if t and f == step else ():
                x, row = np.array(inputs(kind, slots, y, True)), total[kind][gate]
                n, z = len(x), float(np.clip(mixer.weights[kind][gate] @ x, -8, 8))
                p = 1 / (1 + math.exp(-z))
                row[:n] += (y - p) * x
                row[n : n + n * n] += p * (1 - p) * np.outer(x, x).ravel()
                row[-2 * lm.BUCKETS + round((z + 8) * 2)] += 1
                row[-lm.BUCKETS + round((z + 8) * 2)] += y
        mixer.step(total, last=step == lm.STEPS - 1)

    h64 = lambda w: mix_word[w] if w in mix_word else mix_word.setdefault(w, lm.word_hash(w))
    mix_word = {None: 1}

    def cut(text):
        """Phrases as lists of places."""
        w = [*words(text), None]
        h, out = [h64(x) for x in w], []
        for i in range(len(w)):
            before = 0
            for back in range(1, lm.REACH + 1):
                before = mix(before + (h[i - back] if i >= back else 0) * m1 * (2 * back + 1))
            if i == 0 or i >= lm.REACH and before % lm.PHRASE == 0 or len(out[-1]) == lm.LIMIT:
                out.append([])
            out[-1].append(i)
        return [(tuple(w[i] for i in part), part) for part in out]

    phrases = collections.Counter(p for t, (_, x) in zip(taught, rows, strict=True) if t for p, _ in cut(x))
    single = sum(n == 1 for n in c.values()), sum(n == 1 for n in phrases.values())
    share = [min(0.999, max(0.001, 1 - (a + 1) / (b + 2))) for a, b in ((single[0], rare), (single[1], sum(phrases.values())))]
    out = []
    for t, (_, text) in zip(taught, rows, strict=True):
        said = [collections.Counter(), collections.Counter()]
        whole = collections.Counter(words(text)), collections.Counter(p for p, _ in cut(text))
        p_code, p_bytes = collections.Counter(), collections.Counter()
        for kind, gate, slots, y, i in bits(text):
            z = float(np.clip(mixer.weights[kind][gate] @ np.array(inputs(kind, slots, y, t)), -8, 8))
            p1 = min(1 - 1e-6, max(1e-6, (1 / (1 + math.exp(-z)) + mixer.map[kind][gate][round((z + 8) * 2)]) / 2))
            (p_code, p_bytes)[kind][i - 1] += math.log10(p1 if y else 1 - p1)
        score = 0.0
        for phrase, places in cut(text):
            p = 0.0
            for i, w in zip(places, phrase, strict=True):
                p += p_code[i]
                if w is not None and w not in number:
                    seen = max(0, c[w] + said[0][w] - (whole[0][w] if t else 0))
                    p += math.log10((1 - share[0]) * 10 ** p_bytes[i] + share[0] * seen / max(rare, 1)) if seen else math.log10(1 - share[0]) + p_bytes[i]
                    said[0][w] += 1
            seen = max(0, phrases[phrase] + said[1][phrase] - (whole[1][phrase] if t else 0))
            score += math.log10((1 - share[1]) * 10**p + share[1] * seen / sum(phrases.values())) if seen else math.log10(1 - share[1]) + p
            said[1][phrase] += 1
        out.append(score)
    return out


def test_scores_equal_a_plain_version(spark, sf_dir):
    rows = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").filter("length(text) < 900").collect())[:45]
    rows += [(r[0] + 5000, r[1]) for r in rows[:6]] + [(10_001, None), (10_002, "new words of no other text"), (10_003, "the the the " * 90), (10_004, "q" * 300)]
    got = {r["doc_id"]: r["score"] for r in lm.score_texts(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)).collect()}
    for (i, _), want in zip(rows, plain_scores(spark, rows), strict=True):
        assert math.isclose(got[i], want, rel_tol=2e-3, abs_tol=2e-3), i


def test_counts_and_base(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows += [(10_001, None), (10_002, ""), (10_003, "q" * 30_000), (10_004, "the " * 30_000), (10_001, None), (None, "ein wort")]
    df = spark.createDataFrame([(i, t, "en", 0.5) for i, t in rows], "doc_id bigint, text string, lang string, score double")
    words = lambda t: (t or "").encode().lower().split()
    out_of = lambda i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0
    c, ends = collections.Counter(), 0
    for i, t in rows:
        if not out_of(i):
            c.update(words(t))
            ends += 1
    n, v = sum(c.values()) + ends, len(c) + 1
    c[None] = ends
    want = collections.Counter((i, out_of(i), len(words(t)) + 1, sum(c[w] > 0 for w in [*words(t), None]), n, round(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in [*words(t), None]), 4)) for i, t in rows)
    got = lm.score_texts(df, head=50).collect()
    assert collections.Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in got) == want
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)


def test_scores_tell_order_copies_and_new_texts_apart(spark, sf_dir):
    rng = random.Random(3)
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir.replace('sf0.001', 'sf0.01')}/documents.parquet").filter("length(text) > 600").collect()]
    once = {t: n for t, n in collections.Counter(t for _, t in rows).items() if n == 1}
    rows = [r for r in rows if r[1] in once]
    shuffled = lambda t: " ".join(rng.sample(t.split(), len(t.split())))
    held = [i for i in range(10**6, 10**6 + 600) if zlib.crc32(str(i).encode()) % 10 == 0][:40]
    teachers = [t for i, t in rows if zlib.crc32(str(i).encode()) % 10][:40]
    copies = [(h, t) for h, t in zip(held[:20], teachers[:20], strict=True)]
    mixed = [(h, shuffled(t)) for h, t in zip(held[20:], teachers[:20], strict=True)]
    df = spark.createDataFrame([*rows, *copies, *mixed], "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in lm.score_texts(df).collect()}
    assert all(got[a]["score"] > got[b]["score"] for (a, _), (b, _) in zip(copies, mixed, strict=True))
    twice = {t for _, t in copies}
    low = max(got[i]["bits_per_byte"] for i, _ in copies)
    others = sorted(got[i]["bits_per_byte"] for i, t in rows if t not in twice)
    assert others[len(others) // 10] > low
    by_held = [r for r in got.values() if r["held_out"]]
    assert sum(r["score"] for r in by_held) > sum(r["base_score"] for r in by_held)


def test_words_codes_are_a_distribution():
    code = lm.Code([b"w%d" % k for k in range(300)], [1 + k * k for k in range(300)], 7, 90)
    assert sum(2.0 ** -int(n) for n in code.lengths) == 1.0 and code.words[0] == b"w299"
    for s in (0, 5, code.end, code.escape):  # the path leads from the root to the symbol
        path = slice(code.starts[s], code.starts[s] + code.lengths[s])
        assert code.nodes[path][0] == len(code.words) and np.all(np.diff(code.nodes[path]) < 0)
    paths = {tuple(zip(code.nodes[a : a + n].tolist(), code.bits[a : a + n].tolist(), strict=True)) for a, n in zip(code.starts, code.lengths, strict=True)}
    assert len(paths) == 302


def test_all_training_texts_teach(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").repartition(4)
    lists = [lm.tokens(r["text"]) for r in df.collect()]
    counts = collections.Counter(w for x in lists for w in x)
    head = {w: n for w, n in counts.items() if n > 1}
    code = lm.Code(list(head), list(head.values()), len(lists), sum(n == 1 for n in counts.values()))
    got = lm.context_counts(df, spark.sparkContext.broadcast(code))
    stream = lm.Stream(lists, lm.Reader(code))
    want = np.zeros((lm.SLOTS, 2))
    for kind, _, y, slots, _ in stream.events():
        for table, s in zip(lm._tables(want.ravel())[kind], slots, strict=True):
            assert np.array_equal(s % 2, y)
            np.add.at(table, s, 1)
    assert np.array_equal(got, want) and want[: 1 << 18].sum() == code.lengths[stream.ids[stream.coded]].sum()


def test_most_frequent_words_are_cut_at_a_count(spark):
    df = spark.createDataFrame([(i, c) for i, c in enumerate([1] * 50 + [2] * 20 + [5] * 10 + [40] * 5 + [1000])], "h int, whole bigint")
    for most, want in ((0, 0), (1, 1), (5, 1), (6, 6), (20, 16), (86, 86), (10**6, 86)):
        got = [r["whole"] for r in most_frequent(df, most).collect()]
        assert len(got) == want and (not got or min(got) > max([0, *(r["whole"] for r in df.collect() if r["whole"] not in got)]))


def test_hashed_share(spark):
    df = spark.range(5000).select(F.col("id").alias("k"))
    some = sorted(r["k"] for r in hashed_share(df, "k", 5000, 1000).collect())
    assert 850 < len(some) <= 1000 and some == sorted(r["k"] for r in hashed_share(df.repartition(7), "k", 5000, 1000).collect())
    assert hashed_share(df, "k", 5000, 5000).count() == 5000


def test_scores_of_nothing_and_without_training(spark):
    empty = docs(spark, [])
    assert lm.score_texts(empty).count() == 0
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    r = lm.score_texts(docs(spark, [(held, "a b", "s")])).first()
    assert (r["train_tokens"], r["n_known"], r["n_tokens"]) == (0, 0, 3) and math.isfinite(r["score"])


# ---- toxicity


def test_block_max_finds_the_nearest():
    rng = np.random.default_rng(3)
    rows = [(i, t, w) for i in range(500) for t, w in zip(np.where(rng.random(6) < 0.3, rng.integers(0, 4, 6), 4 + (rng.integers(0, 400, 6) + i) % 400), rng.random(6), strict=True)]
    rows = list({(i, int(t)): (i, int(t), w) for i, t, w in rows}.values())
    entry, term, weight = (np.array(x) for x in zip(*rows, strict=True))
    weight = weight / np.sqrt(np.bincount(entry, weight**2))[entry]
    whole = np.zeros((500, 404))
    whole[entry, term] = weight
    index = toxicity.BlockMaxIndex(np.bincount(entry, minlength=500), term, weight, 404, block=16)
    assert len(index.rows) == 4 and index.blocks == 32
    for q in range(0, 500, 25):
        terms = np.nonzero(whole[q])[0]
        for without in (-1, q):
            scores = whole @ whole[q]
            want = sorted((round(-x, 5), i) for i, x in enumerate(scores) if x > 0 and i != without)[:7]
            found, cosine = index.nearest(terms, whole[q][terms], 7, without)
            assert np.allclose([-x for x, _ in want], cosine, atol=1e-5) and set(found.tolist()) <= {i for i, x in enumerate(scores) if -x <= want[-1][0] + 1e-4}


def plain_toxicity(spark, rows, labels, k=15):
    """score of each row by plain Python: every cosine to every example."""
    bags = [collections.Counter(toxicity.words(t)) for _, t in rows]
    taught = {i: y for i, y in labels.items() if zlib.crc32(str(i).encode()) % 5}
    examples = spark.createDataFrame([(i, t, taught[i]) for i, t in rows if i in taught], "doc_id bigint, text string, toxic int")
    boost = toxicity.choose_terms(examples, 2000)
    known = {w for b, (i, _) in zip(bags, rows, strict=True) if i in taught for w in b}
    tied = {t for t in boost if t.endswith("*")}

    def bag(b):
        out = {w: c for w, c in b.items() if w in known}
        for w, c in b.items():
            for t in toxicity.terms_of(w)[1:]:
                if t in tied:
                    out[t] = out.get(t, 0) + c
        return out

    df = collections.Counter(w for b in bags for w in bag(b))
    idf = lambda w: (math.log((1 + len(rows)) / (1 + df[w])) + 1) * boost.get(w, 1.0)

    def unit(b):
        v = {w: (1 + math.log(c)) * idf(w) for w, c in bag(b).items()}
        norm = math.sqrt(sum(x * x for x in v.values()) + sum(((1 + math.log(c)) * (math.log(1 + len(rows)) + 1)) ** 2 for w, c in b.items() if w not in known))
        return {w: x / norm for w, x in v.items()}

    texts = collections.defaultdict(list)
    for (i, t), b in zip(rows, bags, strict=True):
        if i in taught and bag(b):
            texts[t].append(i)
    share = {t: sum(taught[i] for i in ids) / len(ids) for t, ids in texts.items()}
    units = {t: unit(collections.Counter(toxicity.words(t))) for t in texts}
    prior = sum(share.values()) / len(share)

    def vote(b, without=None):
        q = unit(b)
        best = sorted((-round(min(1.0, c), toxicity.DIGITS), min(texts[t]), t) for t, u in units.items() if t != without and (c := sum(x * u.get(w, 0) for w, x in q.items())) > 0)[:k]
        w = [1 / (1 + c + toxicity.CLOSE) ** toxicity.POWER for c, _, _ in best]
        return (prior + sum(x * share[t] for x, (_, _, t) in zip(w, best, strict=True))) / (1 + sum(w))

    own = {t: vote(collections.Counter(toxicity.words(t)), t) for t in texts}
    a, c = toxicity.calibration(np.array([own[t] for t in texts]), np.array([share[t] for t in texts]), np.ones(len(texts)))
    return [1 / (1 + math.exp(-a * math.log(v / (1 - v)) - c)) for v in (vote(b) for b in bags)]


def test_toxicity_query_equals_brute_force(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").filter("toxic is not null").collect()}
    got = {r["doc_id"]: r for r in queries.op10_toxicity(spark, sf_dir).collect()}
    assert len(got) == len(rows) and sum(labels.values()) > 3
    want = plain_toxicity(spark, rows, labels)
    off = [abs(got[i]["score"] - x) for (i, _), x in zip(rows, want, strict=True)]
    assert max(off) < 1e-3, sorted(off)[-5:]


def test_toxicity_of_shared_ids_and_of_rows_in_another_order(spark):
    rng = random.Random(8)
    word = lambda n: f"w{rng.randrange(n)}"
    rows = [(i // 2, " ".join(word(60) for _ in range(8)) + (" vile" if i // 2 % 4 == 0 else ""), "s") for i in range(400)]
    rows += [(1000 + i, rows[i][1], "s") for i in range(40)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(200)], "doc_id bigint, toxic int")
    seen = []
    for order in (rows, rows[::-1]):
        got = toxicity.score_toxicity(docs(spark, order).repartition(1 + len(seen) * 6), labels).collect()
        assert len(got) == len(rows)
        seen.append(sorted((r["doc_id"], r["text_hash"], round(r["score"], 5), tuple((e["doc_id"], e["toxic"]) for e in r["evidence"])) for r in got))
    assert seen[0] == seen[1]
    assert len({x[2] for x in seen[0]}) > 2


def test_calibration_fits_rates():
    rng = np.random.default_rng(1)
    votes = rng.uniform(0.01, 0.99, 20_000)
    truth = 1 / (1 + np.exp(-(2.5 * np.log(votes / (1 - votes)) - 1)))
    a, b = toxicity.calibration(votes, (rng.random(20_000) < truth).astype(float), np.ones(20_000))
    assert abs(a - 2.5) < 0.2 and abs(b + 1) < 0.2


def test_toxic_texts_are_found(spark):
    rng = random.Random(6)
    clean = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta"]
    rows, labels = [], []
    for i in range(400):
        words = [rng.choice(clean) for _ in range(30)]
        if bad := i % 8 == 0:
            words[rng.randrange(30)] = rng.choice(["vile", "nasty"])
        rows.append((i, " ".join(words), "s"))
        labels.append((i, int(bad)))
    rows += [(1000, None, None), (1001, "", "s"), (1002, "vile " * 20_000, "s"), (1002, "alpha", "s"), (None, "nasty alpha", "s")]
    df = docs(spark, rows).withColumn("toxic", F.lit("mine")).withColumn("predicted", F.lit(7))
    got = toxicity.score_toxicity(df, spark.createDataFrame([*labels, (5, None), (None, 1)], "doc_id bigint, toxic int")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
        if r["doc_id"] is not None and r["doc_id"] < 400:
            assert r["predicted"] == int(r["doc_id"] % 8 == 0)
            assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
    assert sum(r["predicted"] for r in got if r["doc_id"] is None or r["doc_id"] >= 1000) == 2
    kept = toxicity.reject_toxic(df, spark.createDataFrame([*labels, (5, None), (None, 1)], "doc_id bigint, toxic int"))
    assert kept.columns == df.columns and kept.count() == len(rows) - 52


def test_copies_of_toxic_examples_are_found_without_terms(spark):
    rng = random.Random(4)
    text = lambda: [f"w{rng.randrange(3000)}" for _ in range(60)]
    taught = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5]
    texts = {i: text() for i in taught}
    bad, good = taught[7], taught[8]
    new = [(1001, texts[bad]), (1002, texts[bad][::-1]), (1003, [*texts[bad][:-2], "other", "words"]), (1004, texts[good]), (1005, text())]
    df = docs(spark, [(i, " ".join(t), "s") for i, t in [*texts.items(), *new]])
    labels = spark.createDataFrame([(i, int(i == bad)) for i in taught], "doc_id bigint, toxic int")
    got = {r["doc_id"]: r for r in toxicity.score_toxicity(df, labels).collect()}
    assert [got[i]["predicted"] for i in (bad, 1001, 1002, 1003, 1004, 1005)] == [1, 1, 1, 1, 0, 0]
    assert [(x["doc_id"], round(x["similarity"], 6)) for x in got[1002]["evidence"]][0] == (bad, 1.0)


def test_toxicity_without_labels_or_texts(spark):
    labels = spark.createDataFrame([], "doc_id bigint, toxic int")
    got = toxicity.score_toxicity(docs(spark, [(1, "a", "s")]), labels).first()
    assert (got["score"], got["predicted"]) == (0.0, 0)
    assert toxicity.score_toxicity(docs(spark, []), labels).count() == 0


# ---- the pipeline


def test_pipeline_follows_its_stages(spark, sf_dir):
    start = spark.read.parquet(f"{sf_dir}/documents.parquet")
    table, seen = start, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, table, sf_dir)
        assert after.columns == start.columns
        after.write.parquet(path := f"{spark.conf.get('spark.checkpoint.dir')}/test-{name.replace(' ', '-')}", mode="overwrite")
        table = spark.read.parquet(path)
        seen.append(table)
    toxic = {r["doc_id"] for r in queries.op10_toxicity(spark, sf_dir).filter("predicted = 1").collect()}
    clean = [(r["doc_id"], r["text"]) for r in start.collect() if r["doc_id"] not in toxic]
    assert sorted(r["doc_id"] for r in seen[0].collect()) == sorted(i for i, _ in clean)
    heads = sorted({c for _, _, c in brute(clean, 5, 80)})
    assert sorted(r["doc_id"] for r in seen[1].collect()) == heads
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix_sources(seen[1]).collect() if r["copies"]}
    assert collections.Counter(r["doc_id"] for r in seen[2].collect()) == copies
    last = corpus_pipeline.run(spark, sf_dir).collect()
    assert collections.Counter(r["doc_id"] for r in last) == copies
    assert all(r["n_tokens"] == len(r["ids"]) for r in last)


def test_pipeline_of_odd_tables(spark, tmp_path):
    same, near = " ".join(f"a{k}" for k in range(60)), " ".join([*(f"a{k}" for k in range(59)), "other"])
    rows = [(5, same, "x"), (2, same, "x"), (2, same, "x"), (None, same, None), (8, near, "x"), (2, "quite another text that nobody else has", "x"), (None, "no id and no copies of it", None), (None, None, "x"), (9, "", "y"), (9, "vile words", "y"), (None, None, "x")]
    rows += [(100 + k, f"plain text number {k} about vile things" if k % 5 == 0 else f"plain text number {k} about nice things", "z") for k in range(60)]
    df = docs(spark, rows).withColumn("toxic", F.lit("mine")).withColumn("fp", F.lit("own")).withColumn("copies", F.lit("c"))
    df.write.parquet(f"{tmp_path}/odd/documents.parquet")
    labels = spark.createDataFrame([(100 + k, int(k % 5 == 0)) for k in range(60)] + [(None, 1), (3, None)], "doc_id bigint, toxic int")
    labels.write.parquet(f"{tmp_path}/odd/labels.parquet")
    table = df
    for _, stage in corpus_pipeline.STAGES[:3]:
        table = stage(spark, table, f"{tmp_path}/odd")
        assert table.columns == df.columns and {r["toxic"] for r in table.select("toxic").distinct().collect()} == {"mine"}
    out = collections.Counter((r["doc_id"], r["lang"], r["n_tokens"]) for r in corpus_pipeline.run(spark, f"{tmp_path}/odd").collect())
    by_id = collections.Counter()
    for (i, _, _), n in out.items():
        by_id[i] += n
    # all of the group of near copies goes but one row of the smallest id; texts under a toxic label go
    assert not {5, 8} & set(by_id) and not {100 + k for k in range(0, 60, 5)} & set(by_id)
    # mixing takes each row that is left as often as its source's rate says, 2 at most
    kept = corpus_pipeline.drop_near_copies(spark, corpus_pipeline.drop_toxic(spark, df, f"{tmp_path}/odd"), "")
    left = collections.Counter((r["doc_id"], r["text"]) for r in kept.collect())
    assert left[2, same] == 1 and left[2, "quite another text that nobody else has"] == 1 and left[None, "no id and no copies of it"] == 1 and left[None, None] == 2 and left[9, ""] == 1
    assert sum(by_id.values()) <= 2 * sum(left.values())
    docs(spark, []).write.parquet(f"{tmp_path}/none/documents.parquet")
    labels.limit(0).write.parquet(f"{tmp_path}/none/labels.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0


def test_forgotten_words_take_no_new_places(monkeypatch):
    """Words with tied beginnings that a worker forgets and meets again keep their places, and their numbers."""
    monkeypatch.setattr(toxicity, "REMEMBERED", 3)
    numbers = toxicity.Numbers(np.sort(np.array([toxicity.word_hash(w) for w in ("abcdefg", "abcdx", "plain")])), ["abcd*", "abcdef*"])
    flat, beginnings = ["abcdefg", "abcdefh", "abcdy", "abcd", "plain", "abcdx", "new"], [[3, 4], [3, 4], [3], [], [], [3], []]
    for _ in range(50):
        for word, own in zip(flat, beginnings, strict=True):
            (code,) = numbers.codes([word]).tolist()
            known = int(numbers.find([word])[0])
            assert (numbers.several[-2 - code] if code < -1 else (code, [])) == (known, own)
    assert len(numbers.several) == 4
