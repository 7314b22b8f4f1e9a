"""Churn features and rule scores per patient.

Visits and surveys are reduced to one row per patient before they meet the patient table, so a
patient with many of both never multiplies rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.exprs import (
    done,
    is_complaint,
    mean,
    mean_if,
    missed,
    money,
    rate_pct,
    round_half_up,
    sum_if,
    with_scalars,
)


def snapshot_row(appointments: DataFrame, snapshot: str | DataFrame | None = None) -> DataFrame:
    """One row with the day recency is measured from: given, or the last visit in the data.

    A frame is a narrow one with the visits' ``appointment_date``: where ``appointments`` is a join, the
    last day is then read without running it again.
    """
    if isinstance(snapshot, DataFrame):
        return snapshot.agg(F.max("appointment_date").alias("__snapshot"))
    day = F.lit(snapshot).cast("date") if snapshot else F.max("appointment_date")
    return appointments.agg(day.alias("__snapshot"))


def patient_activity(appointments: DataFrame, *more: Column) -> DataFrame:
    """Visits reduced to one row per patient."""
    return appointments.groupBy("patient_id").agg(
        F.max("appointment_date").alias("last_visit"),
        F.count("*").alias("total_appointments"),
        rate_pct(F.count_if(missed()), F.count("*")).alias("no_show_rate_pct"),
        *more,
    )


def patient_opinion(surveys: DataFrame) -> DataFrame:
    """Surveys reduced to one row per patient."""
    return surveys.groupBy("patient_id").agg(
        mean("overall_score").alias("__score"),
        mean("wait_time_rating").alias("__wait_rating"),
        F.count_if(is_complaint()).alias("complaint_count"),
        F.count("*").alias("__surveys"),
    )


def _profile(patients: DataFrame, activity: DataFrame, surveys: DataFrame | None,
             snapshot: DataFrame, how: str = "left") -> DataFrame:
    joined = patients.join(activity, "patient_id", how)
    if surveys is not None:
        joined = joined.join(patient_opinion(surveys), "patient_id", "left")
    return with_scalars(joined, snapshot).withColumn("__days", F.datediff("__snapshot", "last_visit"))


def _score_or(default: float) -> Column:
    return F.coalesce(round_half_up(F.col("__score")), F.lit(default))


def churn_features(patients: DataFrame, appointments: DataFrame, surveys: DataFrame,
                   snapshot: str | DataFrame | None = None) -> DataFrame:
    """A3: recency, frequency, value and satisfaction per patient, with defaults 5, 3 and 0.

    Distinct visits are counted over two columns only; inside the other aggregate they would make
    Spark shuffle every visit with all its sums.
    """
    visits = appointments.select("patient_id", "appointment_id").distinct().groupBy("patient_id").agg(
        F.count("appointment_id").alias("appointment_count")
    )
    activity = appointments.groupBy("patient_id").agg(
        F.max("appointment_date").alias("last_visit"),
        money(sum_if(done(), "billed_amount")).alias("visits_billed"),
        round_half_up(mean_if(done(), "billed_amount")).alias("avg_billed"),
        round_half_up(mean("wait_days"), 1).alias("avg_wait_days"),
        rate_pct(F.count_if(F.col("appointment_type") == "telehealth"), F.count("*")).alias("telehealth_pct"),
        rate_pct(F.count_if(missed()), F.count("*")).alias("no_show_rate_pct"),
    )
    people = patients.select("patient_id", "insurance_type", "state", "chronic_conditions", "churn_flag")
    return _profile(people, activity.join(visits, "patient_id"), surveys, snapshot_row(appointments, snapshot)).select(
        *people.columns,
        F.col("__days").alias("days_since_visit"),
        "appointment_count", F.col("visits_billed").alias("total_billed"), "avg_billed", "avg_wait_days",
        "telehealth_pct", "no_show_rate_pct",
        _score_or(5.0).alias("avg_overall_score"),
        F.coalesce(round_half_up(F.col("__wait_rating")), F.lit(3.0)).alias("avg_wait_rating"),
        F.coalesce("complaint_count", F.lit(0)).alias("complaint_count"),
    )


def churn_rule_scores(patients: DataFrame, appointments: DataFrame, surveys: DataFrame,
                      snapshot: str | DataFrame | None = None, fanout: bool = False, with_no_show: bool = False) -> DataFrame:
    """A4: 0 to 5 points for inactivity, a single visit and low satisfaction, with a band.

    ``fanout=True`` counts a visit once per survey of the patient, as a three-way join would.
    """
    people = patients.select("patient_id", "churn_flag", "insurance_type", "total_billed")
    rows = _profile(people, patient_activity(appointments), surveys, snapshot_row(appointments, snapshot))
    visits = F.coalesce("total_appointments", F.lit(0))
    if fanout:
        visits = visits * F.greatest(F.coalesce("__surveys", F.lit(0)), F.lit(1))
    days, score = F.col("__days"), F.coalesce("__score", F.lit(5.0))
    points = (
        F.when(days > 180, 2).when(days > 90, 1).otherwise(0)
        + F.when(F.col("appt_count") == 1, 1).otherwise(0)
        + F.when(score < 4, 2).when(score < 6, 1).otherwise(0)
    )
    return (
        rows.withColumn("appt_count", visits)
        .withColumn("churn_risk_score", points)
        .select(
            "patient_id", "churn_flag", "insurance_type", money(F.col("total_billed")).alias("lifetime_billed"),
            days.alias("days_inactive"), "appt_count", round_half_up(score).alias("avg_satisfaction"),
            "churn_risk_score",
            F.when(F.col("churn_risk_score") >= 4, "HIGH").when(F.col("churn_risk_score") >= 2, "MEDIUM")
            .otherwise("LOW").alias("churn_risk_band"),
            *(["no_show_rate_pct"] if with_no_show else []),
        )
    )


def priority_retention(patients: DataFrame, appointments: DataFrame, surveys: DataFrame,
                       snapshot: str | DataFrame | None = None, limit: int = 50, min_billed: float = 500,
                       min_days: int = 90) -> DataFrame:
    """A5: the ``limit`` most valuable inactive patients who have not churned (ties by id)."""
    activity = appointments.groupBy("patient_id").agg(F.max("appointment_date").alias("last_visit"))
    people = patients.filter((F.col("total_billed") > min_billed) & (F.col("churn_flag") == 0)).select(
        "patient_id", "insurance_type", "state", "total_billed", "churn_flag"
    )
    rows = _profile(people, activity, surveys, snapshot_row(appointments, snapshot))
    return (
        rows.filter(F.col("__days") > min_days)
        .select(
            "patient_id", "insurance_type", "state", money(F.col("total_billed")).alias("lifetime_billed_aud"),
            F.col("__days").alias("days_inactive"), _score_or(5.0).alias("avg_satisfaction"), "churn_flag",
        )
        .orderBy(F.desc("lifetime_billed_aud"), "patient_id")
        .limit(limit)
    )


def churn_risk_view(patients: DataFrame, appointments: DataFrame, surveys: DataFrame,
                    snapshot: str | DataFrame | None = None) -> DataFrame:
    """V2: profile, recency, satisfaction and the band by inactivity (never seen counts as LOW)."""
    people = patients.select("patient_id", "insurance_type", "state", "churn_flag", "total_billed")
    rows = _profile(people, patient_activity(appointments), surveys, snapshot_row(appointments, snapshot))
    days = F.col("__days")
    return rows.select(
        "patient_id", "insurance_type", "state", "churn_flag",
        money(F.col("total_billed")).alias("lifetime_billed_aud"), days.alias("days_since_last_visit"),
        "total_appointments", "no_show_rate_pct", _score_or(5.0).alias("avg_satisfaction"),
        F.when(days > 180, "HIGH").when(days > 90, "MEDIUM").otherwise("LOW").alias("churn_risk_band"),
    )


def retention_priority_view(patients: DataFrame, appointments: DataFrame, snapshot: str | DataFrame | None = None) -> DataFrame:
    """V7: valuable patients with a visit, inactive for more than 60 days, not churned."""
    people = patients.filter("total_billed > 500 AND churn_flag = 0").select(
        "patient_id", "insurance_type", "state", "total_billed"
    )
    rows = _profile(people, patient_activity(appointments), None, snapshot_row(appointments, snapshot), "inner")
    return rows.filter("__days > 60").select(
        "patient_id", "insurance_type", "state", money(F.col("total_billed")).alias("lifetime_billed_aud"),
        F.col("__days").alias("days_inactive"), "no_show_rate_pct",
    )


def valuable_inactive(patients: DataFrame, appointments: DataFrame, surveys: DataFrame,
                      snapshot: str | DataFrame | None = None) -> DataFrame:
    """The step-by-step feature table of valuable patients inactive for more than 60 days."""
    activity = patient_activity(appointments, round_half_up(mean("wait_days"), 1).alias("avg_wait_days"))
    people = patients.filter("total_billed > 500 AND churn_flag = 0").select(
        "patient_id", "insurance_type", "state", "churn_flag", "total_billed"
    )
    rows = _profile(people, activity, surveys, snapshot_row(appointments, snapshot))
    return rows.filter("__days > 60").select(
        "patient_id", "insurance_type", "state", "churn_flag",
        money(F.col("total_billed")).alias("lifetime_billed_aud"), F.col("__days").alias("days_inactive"),
        "total_appointments", "no_show_rate_pct", "avg_wait_days", _score_or(5.0).alias("avg_satisfaction"),
        F.coalesce("complaint_count", F.lit(0)).alias("complaint_count"),
    )


def inactive_patients(patients: DataFrame, appointments: DataFrame, snapshot: str | DataFrame | None = None,
                      min_days: int = 90) -> DataFrame:
    """Patients whose last visit is more than ``min_days`` ago."""
    activity = appointments.groupBy("patient_id").agg(F.max("appointment_date").alias("last_visit"))
    people = patients.select("patient_id", "insurance_type", "state", "churn_flag")
    rows = _profile(people, activity, None, snapshot_row(appointments, snapshot), "inner")
    return rows.filter(F.col("__days") > min_days).select(
        *people.columns, F.col("last_visit").alias("last_visit_date"), F.col("__days").alias("days_inactive")
    )


def flag_high_churn(churn_risk: DataFrame, threshold: int = 100) -> DataFrame:
    """How many high-risk patients have not churned, and whether that calls for an alert."""
    hit = (F.col("churn_risk_band") == "HIGH") & (F.col("churn_flag") == 0)
    return churn_risk.agg(F.count_if(hit).alias("high_risk_patients")).withColumn(
        "alert", F.col("high_risk_patients") > threshold
    )


def churn_alert(retention: DataFrame, high: int = 50) -> DataFrame:
    """P5: high (over 180 days) and medium (90 to 180) counts of the retention view."""
    days = F.col("days_inactive")
    return retention.agg(
        F.count_if(days > 180).alias("high_risk"), F.count_if(days.between(90, 180)).alias("medium_risk")
    ).withColumn("alert", F.col("high_risk") > high)
