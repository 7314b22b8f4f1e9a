"""Data sets behind the dashboard; drawing is left to the client."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from ..functions.exprs import done, in_months, mean_if, missed, money, rate_pct, round_half_up, sum_if, with_scalars
from .kpis import band, bulk_billing_rate, churn_by_state, is_bulk, revenue_pivot, satisfaction_monthly

ALL = "ALL"


def filter_slice(appointments: DataFrame, specialty: str = ALL, clinic: int | str = ALL, kind: str = ALL,
                 start: str | dt.date | None = None, end: str | dt.date | None = None) -> DataFrame:
    """The chosen specialty, clinic, visit type and inclusive date range; ``ALL`` keeps everything.

    On a saved table only the months of the range are read.
    """
    first, last = (F.lit(day).cast("date") if day else None for day in (start, end))
    out = in_months(appointments, first, last)
    for column, wanted in (("specialty", specialty), ("clinic_id", clinic), ("appointment_type", kind)):
        if wanted != ALL:
            out = out.filter(F.col(column) == wanted)
    if first is not None:
        out = out.filter(F.col("appointment_date") >= first)
    if last is not None:
        out = out.filter(F.col("appointment_date") <= last)
    return out


def kpi_cards(appointments: DataFrame, patients: DataFrame) -> DataFrame:
    """B1: the six headline numbers, one row."""
    cards = appointments.agg(
        money(sum_if(done(), "billed_amount")).alias("total_revenue"),
        rate_pct(F.count_if(done() & is_bulk()), F.count_if(done())).alias("bulk_billing_rate"),
        round_half_up(mean_if(done(), "wait_days")).alias("avg_wait_days"),
        rate_pct(F.count_if(missed()), F.count("*")).alias("no_show_rate"),
    )
    visits = appointments.filter(done()).select("appointment_id").distinct().agg(
        F.count("appointment_id").alias("completed_appointments")
    )
    churn = patients.agg(
        F.coalesce(rate_pct(F.sum("churn_flag"), F.count("*")), F.lit(0.0)).alias("churn_rate")
    )
    return with_scalars(with_scalars(cards, visits), churn)


def revenue_trend(appointments: DataFrame) -> DataFrame:
    """B2: revenue per billing type, bulk rate, and the mean of the monthly rates."""
    rates = bulk_billing_rate(appointments).filter("total_completed > 0").select("month", "bulk_billing_rate_pct")
    hundredths = F.sum(F.round(F.col("bulk_billing_rate_pct") * 100).cast("long"))
    average = rates.agg(
        round_half_up(hundredths.cast("double") / F.count("*") / F.lit(100.0)).alias("avg_bulk_rate_pct")
    )
    return with_scalars(revenue_pivot(appointments).join(rates, "month"), average)


def satisfaction_chart(surveys: DataFrame) -> DataFrame:
    """Monthly score and recommendation share with a band."""
    return satisfaction_monthly(surveys).withColumn(
        "band", band(F.col("recommend_rate"), (0.70, "green"), (0.55, "orange"), otherwise="red")
    )


def churn_chart(patients: DataFrame) -> DataFrame:
    """Churn share per state with a band."""
    return churn_by_state(patients).withColumn(
        "band", band(F.col("churn_rate"), (25, "red"), (18, "orange"), otherwise="green")
    )


def filter_options(appointments: DataFrame) -> DataFrame:
    """The values each filter offers, and the date range, as (filter, value) rows."""
    kinds = ["specialty", "clinic_id", "appointment_type"]
    values = appointments.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("filter"), F.col(c).cast("string").alias("value")) for c in kinds
    ]))).filter("value IS NOT NULL").distinct()
    ends = appointments.agg(F.min("appointment_date").alias("a"), F.max("appointment_date").alias("b"))
    dates = ends.select(F.inline(F.array(
        F.struct(F.lit("date_min").alias("filter"), F.col("a").cast("string").alias("value")),
        F.struct(F.lit("date_max").alias("filter"), F.col("b").cast("string").alias("value")),
    )))
    return values.unionByName(dates)
