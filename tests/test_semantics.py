"""Hand-computed answers for the decisions where definitions could differ."""

from fixtures import appointments, d, rows

from spark_revenue.functions.exprs import month_number, top_value
from spark_revenue.operators import churn_rules as c
from spark_revenue.operators import joins as j
from spark_revenue.operators import kpis as k
from spark_revenue.operators import leakage as l
from spark_revenue.operators import model as m
from spark_revenue.operators import rootcause as r
from spark_revenue.operators import segmentation as g
from spark_revenue.operators import windows as w


def test_month_without_completed_visits_gives_null_rate(spark):
    df = appointments(spark, [{"status": "cancelled"}, {"appointment_date": d("2024-02-01")}])
    got = {row.month: row.bulk_billing_rate_pct for row in k.bulk_billing_rate(df).collect()}
    assert got == {d("2024-01-01"): None, d("2024-02-01"): 100.0}


def test_month_number_is_one_based(spark):
    df = appointments(spark, [{"appointment_date": d("2023-11-30")}, {"appointment_date": d("2024-02-01")}])
    assert [x[0] for x in rows(month_number(df), "month_num")] == [1, 4]


def test_specialty_in_only_one_month(spark):
    df = appointments(spark, [
        {"appointment_date": d("2024-01-05"), "specialty": "Old", "billed_amount": 80},
        {"appointment_date": d("2024-02-05"), "specialty": "New", "billed_amount": 60},
    ])
    got = {x.specialty: (float(x.m6_revenue), float(x.m7_revenue), x.volume_effect, x.rate_effect, x.mix_effect)
           for x in r.month_pair_effects(df).collect()}
    assert got == {"Old": (80.0, 0.0, -80.0, -80.0, 80.0), "New": (0.0, 60.0, 0.0, 0.0, 60.0)}


def test_one_visit_two_surveys(spark):
    patients = spark.createDataFrame(
        [(1, 0, "x", "NSW", 900.0), (2, 0, "x", "NSW", 900.0)],
        "patient_id int, churn_flag int, insurance_type string, state string, total_billed double")
    patients = patients.withColumn("total_billed", patients.total_billed.cast("decimal(18,2)"))
    visits = appointments(spark, [{"patient_id": 1, "appointment_date": d("2024-01-01")}])
    surveys = spark.createDataFrame([(1, 8, 3, "None"), (1, 6, 3, None)],
                                    "patient_id int, overall_score int, wait_time_rating int, complaint_category string")
    plain = {x.patient_id: x for x in c.churn_rule_scores(patients, visits, surveys, "2024-12-31").collect()}
    assert (plain[1].appt_count, plain[1].churn_risk_score, plain[1].churn_risk_band) == (1, 3, "MEDIUM")
    fan = {x.patient_id: x for x in c.churn_rule_scores(patients, visits, surveys, "2024-12-31", fanout=True).collect()}
    assert (fan[1].appt_count, fan[1].churn_risk_score) == (2, 2)
    # Patient 2 has no visit: no inactivity points, default score 5.
    assert (plain[2].days_inactive, plain[2].appt_count, plain[2].churn_risk_score) == (None, 0, 1)
    risk = {x.patient_id: x for x in c.churn_risk_view(patients, visits, surveys, "2024-12-31").collect()}
    assert (risk[1].churn_risk_band, risk[2].churn_risk_band) == ("HIGH", "LOW")
    assert rows(j.never_seen(patients, visits), "patient_id") == [(2,)]


def test_bands_at_their_edges(spark):
    df = spark.createDataFrame([(0.0,), (0.30,), (0.60,), (0.600001,), (1.0,)], "churn_probability double")
    assert [x.risk_band for x in m.band_scores(df).collect()] == ["Low", "Medium", "Medium", "High", "High"]
    assert [x.risk_band for x in m.band_scores(df, True).collect()] == ["Low", "Low", "Medium", "High", "High"]


def test_reason_mode_skips_none_and_breaks_ties(spark):
    df = spark.createDataFrame(
        [("a", "None"), ("a", "None"), ("a", None), ("a", "Y"), ("a", "X"), ("b", None)], "k string, r string")
    assert rows(top_value(df, ["k"], "r", "top")) == [("a", "X")]


def test_ties_in_rankings(spark):
    df = spark.createDataFrame([(1, "NSW", 10.0), (2, "NSW", 10.0), (3, "NSW", 5.0)],
                               "patient_id int, state string, total_billed double")
    df = df.withColumn("total_billed", df.total_billed.cast("decimal(18,2)"))
    got = rows(w.patient_ranks(df), "patient_id", "row_number", "rank", "dense_rank")
    assert got == [(1, 1, 1, 1), (2, 2, 1, 1), (3, 3, 3, 2)]
    pareto = rows(w.patient_pareto(df), "patient_id", "percentile", "cumulative_revenue_pct")
    assert pareto == [(1, 50.0, 40.0), (2, 50.0, 80.0), (3, 0.0, 100.0)]


def test_all_equal_values_share_a_quartile_score(spark):
    df = spark.createDataFrame([(i, 10, 4, 50.0, 3.0, 400) for i in range(8)],
                               "patient_id int, recency int, frequency long, value double, avg_wait_days double, "
                               "days_since_first_appt int")
    assert {tuple(x) for x in g.quartile_scores(df).select("R", "F", "V").collect()} == {(4, 1, 1)}


def test_rescheduled_visits_stay_in_rfv(spark):
    df = appointments(spark, [
        {"status": "rescheduled", "billed_amount": 0}, {"status": "no_show"}, {"status": "Cancelled"}, {"status": None}])
    assert rows(g.rfv(df), "patient_id", "frequency") == [(1, 2)]
    assert g.rfv(df, strict_completed=True).count() == 0


def test_age_on_a_leap_day(spark):
    df = spark.createDataFrame([(d("2000-02-29"),)], "b date")
    from pyspark.sql import functions as F

    ages = [df.select(j.age_in_years("b", F.lit(x).cast("date"))).first()[0] for x in ("2024-02-28", "2024-02-29")]
    assert ages == [23, 24]


def test_golden_shares_and_recoveries(spark):
    """Published bucket amounts: shares of the published gross and the three recovery levels."""
    amounts = {"medicare": 21662.05, "private": 43674.14, "no_show": 298799.25, "self_pay": 42370.92,
               "erosion": 8125.0848592206685}
    one = spark.createDataFrame([(1547162.07, *amounts.values())], "gross double, " + ", ".join(f"{x} double" for x in amounts))
    got = {x.bucket: x.pct_of_gross for x in l.summarise(one).collect()}
    assert round(got["Bucket 3: No-Show Loss"], 4) == 19.3127
    assert round(got["Bucket 2: Private Ins. Reject/Partial"], 4) == 2.8229
    assert round(got["Bucket 4: Self-Pay Defaults"], 4) == 2.7386
    assert round(got["Bucket 1: Medicare Rejections"], 4) == 1.4001
    assert round(got["Bucket 5: Bulk Bill Erosion"], 4) == 0.5252


def test_wait_proxy_matches_published_clinics(spark):
    from spark_revenue.operators.profitability import wait_proxy

    df = spark.createDataFrame(
        [("a", 30.050730207532666), ("b", 23.156451612903226), ("c", 15.212590299277606), ("d", 11.38888888888889)],
        "clinic_name string, avg_wait_days double")
    got = {x.clinic_name: round(x.satisfaction_proxy, 6) for x in wait_proxy(df).collect()}
    assert got == {"a": 3.0, "b": 3.738864, "c": 4.590212, "d": 5.0}


def test_revenue_at_risk_golden(spark):
    df = spark.createDataFrame([(1, 0, 1850.17, 0.7198166009071854)],
                               "patient_id int, churn_flag int, total_billed double, churn_probability double")
    assert round(m.revenue_at_risk(m.band_scores(df)).first().revenue_at_risk, 4) == 1331.7831
