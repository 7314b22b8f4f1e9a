"""Every query with a SQL counterpart gives the same values in DuckDB."""

import pytest
from compare import check, duck

from spark_revenue.plans.catalog import ORACLE, run

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_as_sql(spark, con, name):
    assert check(run(spark, FOLDER, name), con, ORACLE[name]) is None


def test_entry(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.count() > 0 and df.columns[0] == "month"
    assert set(entry.oracle_sql()) <= set(entry.queries())
