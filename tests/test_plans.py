"""Plans keep to the JVM, read only what they need and never sort an unbounded group in one task."""

import re

from spark_revenue.plans.catalog import JOBS, ORACLE, run
from spark_revenue.sources.binding import DomainTables

FOLDER = "/root/testdata/sf0.001"
# Trained models are fitted when the query is built; their plans are checked through f01 and f04.
TRAINED = {"f05a_logistic_metrics", "f05b_boosting_metrics", "f05f_cross_validation",
           "f05i_cross_validation_boosting", "f06_score_patients",
           "f09_importance_boosting", "f09b_importance_logistic", "f10_mean_attribution", "f11_explain_top_patient"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_and_no_pair_joins(spark):
    for name in JOBS:
        if name in TRAINED:
            continue
        plan = plan_of(run(spark, FOLDER, name))
        for banned in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert banned not in plan, f"{name}: {banned}"


def test_only_trained_and_hash_queries_lack_sql():
    assert set(JOBS) - set(ORACLE) == TRAINED | {"f04_stratified_split"}
    assert set(ORACLE) <= set(JOBS)


def test_column_pruning_and_pushdown(spark):
    plan = plan_of(run(spark, FOLDER, "k03_wait_by_specialty"))
    assert "l_extendedprice" not in plan and "orders.parquet" not in plan
    plan = plan_of(run(spark, FOLDER, "p03_leakage_report"))
    assert "o_custkey" not in plan


def test_filters_and_columns_reach_a_table_scan(spark, tmp_path):
    from spark_revenue.operators.kpis import wait_by_specialty

    DomainTables(spark, FOLDER).appointments().write.parquet(str(tmp_path / "appointments"))
    plan = plan_of(wait_by_specialty(spark.read.parquet(str(tmp_path / "appointments"))))
    assert "EqualTo(status,completed)" in plan
    assert "ReadSchema: struct<specialty:string,wait_days:int,status:string>" in plan


# Queries whose first or last day comes from a scan of the date alone.
ONE_JOIN = ["a03_churn_features", "a04_churn_rule_scores", "a05_priority_retention", "a08_bulk_erosion_by_month",
            "a12_month_comparison", "a13_revenue_bridge", "v02_churn_risk", "v07_retention_priority", "d01_age_bands",
            "d02_inactive_patients", "x01_valuable_inactive", "r01_rfv", "f01_churn_features", "f06b_risk_bands",
            "a02_month_pair_effects", "e01_churn_prevention"]


def test_last_day_does_not_repeat_the_join(spark):
    for name in ONE_JOIN:
        plan = plan_of(run(spark, FOLDER, name))
        scans = re.findall(r"lineitem\.parquet\].*ReadSchema: struct<(.*)", plan)
        # A subquery is printed wherever it is used, but runs once; none of its scans may feed a join.
        wide = [s for s in scans if "l_orderkey" in s or "l_partkey" in s]
        # a03 counts distinct visits in a pass of its own over the two ids.
        assert len(wide) == (2 if name == "a03_churn_features" else 1), f"{name}: {scans}"


def test_leakage_reads_visits_once(spark):
    for name in ("l01_bucket_counts", "l06_leakage_summary", "l10_leakage_headline"):
        assert plan_of(run(spark, FOLDER, name)).count("lineitem.parquet]") == 1, name


def test_big_state_is_ranked_in_slices(spark):
    from spark_revenue.operators.windows import patient_ranks

    plan = plan_of(patient_ranks(DomainTables(spark, FOLDER).patients()))
    keys = re.findall(r"windowspecdefinition\(([^)]*?)(?: ASC| DESC)", plan)
    by_row = [k for k in keys if "total_billed" in k]
    assert by_row and all("__slice" in k for k in by_row)


def test_hot_patient_is_split_and_result_is_whole(spark):
    """A third of all visits belong to one patient: same journey as a plain window."""
    from pyspark.sql import Window, functions as F

    from spark_revenue.operators.windows import patient_journey

    t = DomainTables(spark, FOLDER)
    visits = t.appointments().withColumn(
        "patient_id", F.when(F.col("appointment_id") % 3 == 0, F.lit(7).cast("long")).otherwise(F.col("patient_id"))
    ).dropDuplicates(["appointment_id"])
    got = patient_journey(visits)
    order = Window.partitionBy("patient_id").orderBy("appointment_date", "appointment_id")
    want = visits.select(
        "patient_id", "appointment_date", F.row_number().over(order).alias("n"),
        F.round(F.sum(F.when(F.col("status") == "completed", F.col("billed_amount")).otherwise(0)).over(
            order.rowsBetween(Window.unboundedPreceding, 0)), 2).alias("run"))
    ours = got.select("patient_id", "appointment_date", F.col("appointment_number").alias("n"),
                      F.col("running_patient_total_aud").alias("run"))
    key = [F.col("patient_id").cast("string"), F.col("appointment_date").cast("string"), F.col("n").cast("string"),
           F.col("run").cast("double")]
    assert sorted(map(tuple, ours.select(*key).collect())) == sorted(map(tuple, want.select(*key).collect()))
