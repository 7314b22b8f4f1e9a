"""Row-level joins, scalar-subquery filters and date buckets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.exprs import done, mean, money, rate_pct, round_half_up, with_scalars
from .churn_rules import snapshot_row
from .kpis import is_bulk


def surveyed_visits(appointments: DataFrame, surveys: DataFrame) -> DataFrame:
    """Completed visits with the columns of their survey."""
    visits = appointments.filter(done()).select("appointment_id", "specialty", "wait_days", "billing_type")
    opinions = surveys.select("appointment_id", "overall_score", "wait_time_rating", "would_recommend")
    return visits.join(opinions, "appointment_id")


def never_seen(patients: DataFrame, visits: DataFrame) -> DataFrame:
    """Patients without any row in ``visits``."""
    people = patients.select("patient_id", "insurance_type", "state", "churn_flag")
    return people.join(visits.select("patient_id"), "patient_id", "left_anti").select(
        "*", F.lit(0).cast("long").alias("total_appointments"), F.lit(None).cast("date").alias("last_appointment_date")
    )


def above_average_value(patients: DataFrame) -> DataFrame:
    """Patients billed more than the average patient."""
    average = patients.agg(mean("total_billed").alias("__avg"))
    rows = with_scalars(patients.select("patient_id", "insurance_type", "state", "total_billed", "churn_flag"), average)
    return rows.filter(F.col("total_billed").cast("double") > F.col("__avg")).select(
        "patient_id", "insurance_type", "state", money(F.col("total_billed")).alias("lifetime_billed_aud"), "churn_flag"
    )


def age_in_years(birth: str | Column, day: str | Column) -> Column:
    """Completed years; a 29 February birthday counts from 1 March in common years."""
    return F.floor(F.months_between(day, birth) / 12)


def age_bands(patients: DataFrame, appointments: DataFrame, snapshot: str | DataFrame | None = None) -> DataFrame:
    """Patients, completed visits, price and bulk share per age band.

    Visits are reduced to one row per patient, so patients need no distinct count.
    """
    per_patient = appointments.filter(done()).groupBy("patient_id").agg(
        F.count("*").alias("__visits"), F.sum("billed_amount").alias("__billed"),
        F.count_if(is_bulk()).alias("__bulk"),
    )
    age = F.col("__age")
    band = (
        F.when(age < 18, "Under 18").when(age < 35, "18-34").when(age < 55, "35-54").when(age < 70, "55-69")
        .otherwise("70+")
    )
    rows = with_scalars(
        patients.select("patient_id", "date_of_birth").join(per_patient, "patient_id"),
        snapshot_row(appointments, snapshot),
    ).withColumn("__age", age_in_years("date_of_birth", "__snapshot"))
    return rows.groupBy(band.alias("age_group")).agg(
        F.count("*").alias("patient_count"),
        F.sum("__visits").alias("total_appointments"),
        round_half_up(F.sum("__billed").cast("double") / F.sum("__visits")).alias("avg_billed_aud"),
        rate_pct(F.sum("__bulk"), F.sum("__visits")).alias("bulk_billing_rate_pct"),
    )
