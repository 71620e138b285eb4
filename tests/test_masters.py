"""Masters by day: one meaning with masters stored whole, the directory of keys, and retention."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from shopweave.operators.upsert import in_window
from shopweave.plans.refresh import refresh_source, upsert_into
from shopweave.session import children
from shopweave.sources import masters
from shopweave.streaming.upserts import stream_upserts

ROW = "a int, b string, at timestamp, v int"
START = dt.datetime(2024, 1, 1)


def rows(rng, n, first, last):
    at = lambda: None if rng.random() < 0.1 else START + dt.timedelta(days=rng.randrange(first, last), hours=rng.randrange(24))
    return [(rng.choice([None, 1, 2, 3, 4]), rng.choice([None, "x", "y", "z"]), at(), rng.randrange(10**6)) for _ in range(n)]


def plain_refresh(old, new, how, keys, start, end):
    """What the docstrings say, on lists."""
    due = [r for r in new if r[2] and start <= r[2].date() <= end]
    if how == "replace":
        return set(old) if not due else set(due) | {r for r in old if not (r[2] and start <= r[2].date() <= end)}
    if how == "append":
        latest = max(r[2] for r in old if r[2])
        due = [r for r in due if r[2] > latest]
    if not keys:
        return set(due) | set(old)
    best = {}
    for side, some in enumerate((due, old)):
        for r in some:
            key = tuple(r["ab".index(k)] for k in keys)
            rank = (side, -(r[2].timestamp() if r[2] else float("-inf")))
            best.setdefault(key, []).append((rank, r))
    return {key: {r for rank, r in some if rank == min(x for x, _ in some)} for key, some in best.items()}


@pytest.mark.parametrize(("how", "keys", "unit"), [("upsert", ["a", "b"], "day"), ("upsert", [], "month"), ("append", ["a", "b"], "month"), ("append", ["a"], "day"), ("replace", [], "day"), ("replace", [], "month")])
def test_whole_and_by_day_mean_the_same(spark, tmp_path, how, keys, unit):
    rng = random.Random(f"{how}{keys}")
    old = rows(rng, 60, 0, 18) + [(9, None, START + dt.timedelta(18), 1)]
    whole, by_day = str(tmp_path / "w"), str(tmp_path / "d")
    masters.write_master(spark.createDataFrame(old, ROW), whole)
    masters.write_master(spark.createDataFrame(old, ROW), by_day, "at", unit=unit)
    for turn in range(2):
        now = [tuple(r) for r in masters.read_master(spark, whole).collect()]
        new = rows(rng, 12, 8, 25)
        start = max(r[2] for r in now if r[2]).date() - dt.timedelta(2)
        today = start + dt.timedelta(1 + 9 * turn)  # rows later than today are stored and land
        df = spark.createDataFrame(new, ROW)
        got = [refresh_source(spark, p, df, lambda x: x, how, "at", today, keys, "at", by=b) for p, b in ((whole, None), (by_day, "at"))]
        assert got[0] == got[1]
        one, two = ([tuple(r) for r in masters.read_master(spark, p).collect()] for p in (whole, by_day))
        order = lambda x: sorted(x, key=str)
        assert order(one) == order(two) and len(one) == got[0]["total"]
        want = plain_refresh(now, new, how, keys, start, today)
        if isinstance(want, dict):
            assert len(one) == len(want) and all(r in want[tuple(r["ab".index(k)] for k in keys)] for r in one)
        else:
            assert set(one) == want and len(one) == len(want)
    assert masters.manifest(spark, by_day).keys == ([] if how == "replace" else keys)


def test_replace_by_another_column(spark, tmp_path):
    schema = "day date, stored timestamp, v int"
    d = lambda n: dt.date(2024, 1, n)
    old = spark.createDataFrame([(d(5), START, 1), (d(9), START, 2), (d(30), START, 3), (None, START, 4)], schema)
    masters.write_master(old, p := str(tmp_path / "m"), "stored", keys=[])
    new = spark.createDataFrame([(d(29), dt.datetime(2024, 2, 2), 5), (d(28), START, 6)], schema)
    refresh_source(spark, p, new, lambda x: x, "replace", "day", d(31), by="stored")
    assert sorted(r["v"] for r in masters.read_master(spark, p).collect()) == [1, 2, 4, 5, 6]
    assert [r[0] for r in old.select(in_window("day", d(6), d(10))).collect()] == [False, True, False, False]


def test_only_the_buckets_of_new_keys_are_read(spark, tmp_path):
    p = str(tmp_path / "m")
    df = spark.range(4_000).select(F.col("id").alias("k"), F.timestamp_seconds(1704067200 + F.col("id") * 3600).alias("at"))
    masters.write_master(df, p, "at", keys=["k"])
    new = spark.createDataFrame([(17, START)], "k bigint, at timestamp")
    of = masters.manifest(spark, p)
    bucket = new.select(masters._bucket(masters.key_hash(["k"])).alias("b")).first()["b"]
    scan = masters.directory(spark, p, of, [bucket])
    assert f"__bucket#" in scan._jdf.queryExecution().toString() and len({f.split("__bucket=")[1].split("/")[0] for f in scan.select(F.input_file_name()).distinct().toPandas().iloc[:, 0]}) == 1
    assert masters.touched_days(spark, p, new, ["k"]) == ["2024-01-01"]
    assert masters.touched_days(spark, p, spark.createDataFrame([(4_000 - 1, START + dt.timedelta(1))], "k int, at timestamp"), ["k"]) == ["2024-01-02", "2024-06-15"]
    files = {f for (f,) in masters.read_master(spark, p, ["2024-01-03"]).select(F.input_file_name()).distinct().collect()}
    assert files and all("__day=2024-01-03" in f for f in files)


def test_refreshes_leave_a_bounded_listing(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(masters, "PARTS", 4)
    p, want = str(tmp_path / "m"), {}
    masters.write_master(spark.createDataFrame([(k, START + dt.timedelta(k % 5), 0) for k in range(20)], "k int, at timestamp, v int"), p, "at", keys=["k"])
    want = {k: 0 for k in range(20)}
    sizes = []
    for turn in range(1, 9):
        new = [(turn % 7, START + dt.timedelta(turn % 5), turn), (100 + turn, START + dt.timedelta(turn % 3), turn)]
        spark.createDataFrame(new, "k int, at timestamp, v int").write.parquet(staged := str(tmp_path / f"new{turn}"))
        upsert_into(spark, p, spark.read.parquet(staged), ["k"], "at", "at")
        want |= {k: v for k, _, v in new}
        assert {r["k"]: r["v"] for r in masters.read_master(spark, p).collect()} == want
        days = sum(len([d for d in children(spark, f"{p}/data/{v}") if d.startswith("__day=")]) for v in children(spark, f"{p}/data"))
        sizes.append((len(children(spark, f"{p}/_manifest")), days, len(children(spark, f"{p}/_keys"))))
    assert max(s[0] for s in sizes) <= 3 and max(s[1] for s in sizes[3:]) <= 5 + 3 * 4 and max(s[2] for s in sizes) <= 4 + 3 and len(sizes) == 8
    with pytest.raises(FileNotFoundError):
        masters.read_master(spark, str(tmp_path / "none"))
    assert masters.read_master(spark, p, number=masters.manifest(spark, p).number - 2).count() == 20 + 6


def test_what_a_writer_at_work_has_written_stays(spark, tmp_path):
    p, df = str(tmp_path / "m"), spark.createDataFrame([(1, START)], "k int, at timestamp")
    for _ in range(3):
        masters.write_master(df, p, "at", keep=1)
    df.write.parquet(f"{p}/data/__version=v4-busy/__day=2024-01-01")
    df.write.parquet(f"{p}/data/__version=v1-dead/__day=2024-01-01")
    masters.retain(spark, p, 1)
    masters.write_master(df, p, "at", keep=1)
    left = children(spark, f"{p}/data")
    assert "__version=v4-busy" in left and "__version=v1-dead" not in left and len(left) == 2 and masters.read_master(spark, p).count() == 1


def test_stream_with_null_and_composite_keys(spark, tmp_path):
    p, inbox = str(tmp_path / "m"), str(tmp_path / "in")
    masters.write_master(spark.createDataFrame([(None, "x", START, 1), (1, None, START, 2), (2, "y", START, 3)], ROW), p, "at", keys=["a", "b"])
    spark.createDataFrame([(None, "x", START + dt.timedelta(3), 10), (1, None, START + dt.timedelta(4), 20)], ROW).write.parquet(inbox)
    stream_upserts(spark, inbox, ROW, p, str(tmp_path / "c"), ["a", "b"], updated="at", by="at").awaitTermination()
    assert sorted(r["v"] for r in masters.read_master(spark, p).collect()) == [3, 10, 20]
