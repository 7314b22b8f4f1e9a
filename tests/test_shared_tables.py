"""Queries that read a join several times store it once."""

import pytest
from test_plans import FOLDER, plan_of

from spark_revenue.plans import jobs_marts, jobs_storage
from spark_revenue.plans.catalog import run
from spark_revenue.sources.binding import DomainTables


def joins_lines(df) -> bool:
    return any("l_orderkey" in line for line in plan_of(df).splitlines() if "lineitem.parquet" in line)


def test_marts_read_one_stored_join(spark, monkeypatch):
    seen, refresh = {}, jobs_storage.m.refresh_marts

    def watched(marts, folder):
        seen.update({name: joins_lines(df) for name, df in marts.items()})
        return refresh(marts, folder)

    monkeypatch.setattr(jobs_storage.m, "refresh_marts", watched)
    counts = {r["view_name"]: r["row_count"] for r in run(spark, FOLDER, "p01_refresh_summaries").collect()}
    assert len(seen) == 5 and not any(seen.values())
    assert counts["vw_churn_risk"] == DomainTables(spark, FOLDER).patients("patient_id").count()


def test_views_read_one_stored_join(spark):
    assert not joins_lines(run(spark, FOLDER, "s08_views"))


def test_visits_are_reduced_before_they_are_shuffled(spark):
    plan = DomainTables(spark, FOLDER).appointments("appointment_date", "billed_amount", "billing_type", "specialty")
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    below = text[text.rindex("Join Inner"):]
    assert "__billed_amount" in below and "__appointment_date" in below
    # Part is joined last, so its columns take no part in the shuffle by order.
    assert "l_orderkey" in below.splitlines()[0]


@pytest.mark.parametrize("name", ["f10_mean_attribution", "f11_explain_top_patient"])
def test_training_and_explaining_share_one_matrix(spark, monkeypatch, name):
    built, matrix = [], jobs_marts._matrix
    monkeypatch.setattr(jobs_marts, "_matrix", lambda t: built.append(t) or matrix(t))
    # No model of this state of the data is stored, so the query trains one.
    monkeypatch.setattr(jobs_marts, "data_version", lambda *_: f"test-{name}")
    found = run(spark, FOLDER, name)
    assert len(built) == 1 and "lineitem.parquet" not in plan_of(found)
    assert found.count() > 0
