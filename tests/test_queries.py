import pytest

from shopweave.plans.queries import ORACLE_SQL, QUERIES

from .oracle import assert_same


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, name):
    assert name in ORACLE_SQL
    assert_same(spark, sf_dir, QUERIES[name], ORACLE_SQL[name])


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(QUERIES) <= set(__spark_entry__.queries())


def test_import_needs_no_session():
    import subprocess
    import sys

    subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; assert e.queries() and e.oracle_sql()"], check=True)
