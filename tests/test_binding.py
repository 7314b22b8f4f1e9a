"""The referential integrity that lets a view skip joins it does not need."""

import pytest

from spark_revenue.sources.binding import DomainTables

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("child,key,parent,parent_key", [
    ("lineitem", "l_orderkey", "orders", "o_orderkey"), ("lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem", "l_suppkey", "supplier", "s_suppkey"), ("customer", "c_nationkey", "nation", "n_nationkey"),
])
def test_every_child_has_one_parent(spark, child, key, parent, parent_key):
    t = DomainTables(spark, FOLDER)
    c, p = t.driver(child), t.driver(parent)
    assert p.count() == p.select(parent_key).distinct().count()
    assert c.join(p, c[key] == p[parent_key], "left_anti").count() == 0


def test_skipped_joins_do_not_change_rows(spark):
    t = DomainTables(spark, FOLDER)
    narrow = t.appointments("appointment_id", "wait_days", "billed_amount")
    full = t.appointments().select(narrow.columns)
    assert narrow.exceptAll(full).count() == 0 and full.exceptAll(narrow).count() == 0
    plan = narrow._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_amounts_equal_a_plain_decimal_cast(spark):
    t = DomainTables(spark, FOLDER)
    both = t.driver("lineitem").selectExpr(
        "cast(rint(l_extendedprice * 100) as bigint) as cents",
        "cast(cast(l_extendedprice as decimal(12,2)) * 100 as bigint) as plain",
        "cast(rint(l_discount * 100) as bigint) as d", "cast(cast(l_discount as decimal(4,2)) * 100 as bigint) as e",
    )
    assert both.filter("cents <> plain OR d <> e").count() == 0
