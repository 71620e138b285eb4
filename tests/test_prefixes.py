import random

import pytest
from pyspark.sql import functions as F

from shopweave.functions import features
from shopweave.operators.prefixes import join_prefixes


def table(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize("longest", [False, True])
def test_equals_brute_force_beyond_the_lookup(spark, longest):
    rng = random.Random(3)
    text = lambda n: "".join(rng.choice("ab1ä") for _ in range(n))
    dim = sorted({text(rng.randint(2, 9)) for _ in range(3000)})
    ids = [None, "", "a", "zzz"] + [text(rng.randint(0, 12)) for _ in range(400)] + ["ab1a" * 3] * 300
    assert len(dim) > features.LOOKUP_ROWS
    got = join_prefixes(table(spark, [(i,) for i in ids], "v string"), "v", table(spark, [(k, f"n-{k}") for k in dim], "id string, name string"), "out", longest=longest).collect()

    def want(v):
        hits = sorted((k for k in dim if v is not None and v.startswith(k)), key=len)
        return f"n-{hits[-1 if longest else 0]}" if hits else v

    assert sorted((repr(r["v"]), repr(r["out"])) for r in got) == sorted((repr(v), repr(want(v))) for v in ids)


def test_equals_the_lookup_where_it_fits(spark):
    dim = table(spark, [("1", "one"), ("12", "twelve"), ("1", "eins"), ("", None), (None, "x"), ("27", "two")], "id string, name string")
    df = table(spark, [("123",), ("27",), ("2",), (None,)], "v string")
    joined = join_prefixes(df, "v", dim, "out").withColumn("plain", features.map_ids(F.col("v"), features.lookup(dim), "prefix")).collect()
    assert len(joined) == 4 and all(r["out"] == r["plain"] for r in joined)


def test_odd_tables(spark):
    dim = table(spark, [("1", "one")], "id string, name string")
    df = table(spark, [(12, "old", 1, 2), (12, "old", 1, 2), (None, "old", 1, 2)], "v int, out string, id int, name int")
    got = join_prefixes(df, "v", dim, "out")
    assert got.columns == df.columns
    assert sorted(str(r["out"]) for r in got.collect()) == ["None", "one", "one"]
    assert sorted(str(r["out"]) for r in join_prefixes(df, "v", dim.limit(0), "out").collect()) == ["12", "12", "None"]
    assert join_prefixes(df.limit(0), "v", dim, "out").count() == 0
    assert [r["out"] for r in join_prefixes(df.limit(1), "v", table(spark, [("", "all")], "id string, name string"), "out").collect()] == ["all"]


def test_no_cross_join(spark):
    dim = table(spark, [("1", "one")], "id string, name string")
    plan = join_prefixes(table(spark, [("1",)], "v string"), "v", dim, "out")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan
