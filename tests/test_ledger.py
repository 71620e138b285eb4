import json
import os

import duckdb
import pytest

from shopweave.plans.queries import ORACLE_SQL, QUERIES
from shopweave.sources import ledger

from .oracle import rows_of

SCHEMA = "data struct<rows: array<struct<id: int, at: struct<day: string>>>>"


@pytest.fixture
def shop(spark, tmp_path):
    landed, store = tmp_path / "landed", tmp_path / "store"
    landed.mkdir()

    def land(name, text):
        (landed / name).parent.mkdir(exist_ok=True)
        (landed / name).write_bytes(text if isinstance(text, bytes) else text.encode())

    land.ingest = lambda: ledger.ingest_pages(spark, str(landed), str(store), "data.rows", SCHEMA)
    land.status = lambda: {os.path.basename(r["path"]): (r["status"], r["n_records"], r["run"]) for r in ledger.read_ledger(spark, str(store)).collect()}
    land.ids = lambda: sorted(r["id"] for r in ledger.read_records(spark, str(store)).collect())
    land.store = store
    return land


def page(*ids):
    return json.dumps({"data": {"rows": [{"id": i, "at": {"day": "x"}, "more": 1} for i in ids]}}, indent=1)


def test_bad_pages_lie_in_quarantine_with_their_reason(spark, shop):
    pages = {"good.json": page(1, 2), "cut.json": page(3)[:-4], "empty.json": "", "blank.json": " \n", "type.json": '{"data": {"rows": [{"id": "x"}]}}', "none.json": '{"data": null}',
             "other.json": '{"error": 1}', "no_rows.json": '{"data": {"rows": []}}', "bytes.json": b"\xff\xfe\x00"}
    for name, text in pages.items():
        shop(name, text)
    shop.ingest()
    want = {n: "malformed" for n in ("cut.json", "blank.json", "type.json", "bytes.json")} | {n: "no_records" for n in ("none.json", "other.json")} | {"good.json": "good", "no_rows.json": "good"}
    # empty.json has no bytes, so Spark does not open it.
    assert {n: s for n, (s, _, _) in shop.status().items()} == want
    assert shop.ids() == [1, 2]
    kept = {os.path.basename(r["path"]): (r["reason"], r["text"]) for r in ledger.read_quarantine(spark, str(shop.store)).collect()}
    assert set(kept) == {n for n, s in want.items() if s != "good"} and kept["cut.json"] == ("malformed", page(3)[:-4])
    assert ledger.read_records(spark, str(shop.store)).columns == ["id", "at_day", "run"]


def test_pages_are_taken_in_once(shop):
    shop("b.json", page(1))
    shop("a.json", page(1))
    shop.ingest()
    assert shop.status() == {"a.json": ("good", 1, 0), "b.json": ("repeated", 0, 0)}
    shop.ingest()
    shop("sub/c.json", page(1))
    shop("d.json", page(2))
    shop.ingest()
    assert shop.status() == {"a.json": ("good", 1, 0), "b.json": ("repeated", 0, 0), "c.json": ("repeated", 0, 1), "d.json": ("good", 1, 1)}
    assert shop.ids() == [1, 2]


def test_old_files_that_land_late_count(shop, tmp_path):
    shop("new.json", page(1))
    shop.ingest()
    shop("old.json", page(2))
    os.utime(tmp_path / "landed" / "old.json", (10**9, 10**9))
    shop.ingest()
    assert shop.ids() == [1, 2]


@pytest.mark.parametrize("ledger_done", [True, False])
def test_a_run_that_broke_off_is_written_anew(shop, ledger_done):
    shop("a.json", page(1))
    shop.ingest()
    shop("b.json", page(2))
    shop("c.json", page(2))
    shop.ingest()
    # As after a crash before the stream's commit, with and without a finished ledger.
    for name in ("1", ".1.crc"):
        (shop.store / "seen" / "commits" / name).unlink(missing_ok=True)
    if not ledger_done:
        (shop.store / "ledger" / "run=1" / "_SUCCESS").unlink()
        assert shop.ids() == [1]
    shop.ingest()
    assert shop.ids() == [1, 2]
    assert shop.status()["b.json"] == ("good", 1, 1) and shop.status()["c.json"] == ("repeated", 0, 1)


def test_nothing_landed(shop):
    shop.ingest()
    with pytest.raises(ValueError, match="no finished run"):
        shop.status()


def test_ledger_of_pages_that_come_twice_in_one_landing(spark, tmp_path):
    # pages 1 (again in the second landing), 3 (malformed), 5 (no records), 29 and 64 (both copies in the second landing)
    spark.createDataFrame([(p * 1000 + i, p, 1.0, "F") for p in (1, 3, 5, 29, 64) for i in (0, 1)], "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderstatus string").write.parquet(str(tmp_path / "orders.parquet"))
    got = QUERIES["ingest_ledger"](spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW orders AS SELECT * FROM '{tmp_path}/orders.parquet/*.parquet'")
    want = con.execute(ORACLE_SQL["ingest_ledger"])
    names = [d[0] for d in want.description]
    assert rows_of(got.columns, got.collect()) == rows_of(names, want.fetchall())
