"""An upsert into a master by day merges and stores in one shuffle by day."""

import datetime as dt
import random

import pytest

from shopweave.operators.upsert import upsert_latest
from shopweave.plans import refresh
from shopweave.sources import masters

KINDS = "k int, s string, at timestamp, v int"


@pytest.mark.parametrize(("unit", "part"), [("day", 100_000), ("month", 5)])
def test_upsert_by_day_equals_upsert_by_key(spark, tmp_path, monkeypatch, unit, part):
    rng = random.Random(unit)
    at = lambda: rng.choice([None, *(dt.datetime(2024, 1, 25) + dt.timedelta(days=d) for d in range(12))])
    row = lambda: (rng.choice([None, *range(60)]), rng.choice([None, "a", "b"]), at(), rng.randrange(1000))
    path, keys = str(tmp_path / "m"), ["k", "s"]
    old = upsert_latest(spark.createDataFrame([row() for _ in range(150)], KINDS), spark.createDataFrame([], KINDS), keys)
    masters.write_master(old, path, "at", keys=keys, unit=unit)
    monkeypatch.setattr(refresh, "PART", part)
    monkeypatch.setattr(refresh, "upsert_latest", lambda *a, **b: pytest.fail("all rows are gathered by key"))
    for turn in range(3):
        spark.createDataFrame([row() for _ in range(40)], KINDS).write.parquet(where := str(tmp_path / f"new{turn}"))
        new, was = spark.read.parquet(where), [tuple(r) for r in masters.read_master(spark, path).collect()]
        want = upsert_latest(new, spark.createDataFrame(was, KINDS), keys, "at").collect()
        refresh.upsert_into(spark, path, new, keys, "at", "at")
        got = masters.read_master(spark, path).collect()
        assert sorted(map(str, got)) == sorted(map(str, want)) and len({(r["k"], r["s"]) for r in got}) == len(got)
        of = masters.manifest(spark, path)
        assert of.total == len(got) and of.keys == keys


def test_columns_of_one_side_stay(spark, tmp_path):
    path = str(tmp_path / "m")
    masters.write_master(spark.createDataFrame([(1, dt.date(2024, 1, 1), "x"), (2, dt.date(2024, 1, 1), "y")], "k int, at date, only string"), path, "at", keys=["k"])
    spark.createDataFrame([(2, dt.date(2024, 1, 3), 5)], "k int, at date, more int").write.parquet(where := str(tmp_path / "new"))
    assert refresh.upsert_into(spark, path, spark.read.parquet(where), ["k"], by="at") == ["2024-01-01", "2024-01-03"]
    got = {r["k"]: (str(r["at"]), r["only"], r["more"]) for r in masters.read_master(spark, path).collect()}
    assert got == {1: ("2024-01-01", "x", None), 2: ("2024-01-03", None, 5)}
