"""What the plans must and must not hold."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from shopweave.plans import adapters as A
from shopweave.plans.queries import QUERIES


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.mark.parametrize("name", ["daily_business", "weekly_market_view", "noun_themes", "clean_orders", "clean_tickets", "upsert_latest", "weighted_draw", "find_duplicates"])
def test_no_python_on_executors(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert not any(x in text for x in ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "MapInArrow", "CartesianProduct"))


def test_scans_are_pruned(spark, sf_dir):
    text = plan(QUERIES["daily_spend"](spark, sf_dir))
    assert "props" not in text and "user_id" not in text
    assert "EqualTo(l_returnflag,R)" in plan(QUERIES["daily_refunds"](spark, sf_dir)).split("PushedFilters", 1)[1]


def test_frequent_keys_are_aggregated_before_they_are_shuffled(spark, sf_dir):
    text = plan(QUERIES["upsert_latest"](spark, sf_dir))
    assert "partial_min_by" in text and "Window" not in text


@pytest.mark.parametrize("broadcast", ["-1", "10MB"])
def test_lines_by_order_keep_the_sessions_partitions(spark, sf_dir, broadcast):
    settings = {"spark.sql.shuffle.partitions": "16", "spark.sql.autoBroadcastJoinThreshold": broadcast}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        for rows in (A.financial_items(spark, sf_dir), A.returns_clean(spark, sf_dir)):
            assert rows.select(F.spark_partition_id().alias("p")).distinct().count() == 16
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
