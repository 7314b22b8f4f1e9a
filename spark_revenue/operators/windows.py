"""Rankings, running totals and journeys.

Month windows run over one row per month.  Patient rankings and journeys go through the sliced
helper, so neither a big state nor a patient with a third of all visits lands in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.exprs import (
    done,
    missed,
    money,
    month_of,
    pct,
    rate_pct,
    round_half_up,
    sum_if,
    with_scalars,
)
from ..functions.ordered import ordered_measures
from .kpis import is_bulk


def _monthly(appointments: DataFrame) -> DataFrame:
    return appointments.groupBy(month_of("appointment_date").alias("month")).agg(
        sum_if(done(), "billed_amount").alias("__revenue"),
        pct(F.count_if(done() & is_bulk()), F.count_if(done())).alias("__bulk"),
    )


def _months():
    return Window.orderBy("month")


def _running():
    return F.sum("__revenue").over(_months().rowsBetween(Window.unboundedPreceding, Window.currentRow))


def _rolling(months: int = 3):
    return F.avg("__bulk").over(_months().rowsBetween(1 - months, Window.currentRow))


def revenue_growth(appointments: DataFrame) -> DataFrame:
    """Monthly revenue, previous month, growth and running total."""
    prev = F.lag("__revenue").over(_months())
    return _monthly(appointments).select(
        "month", money(F.col("__revenue")).alias("monthly_revenue"), money(prev).alias("prev_month_revenue"),
        rate_pct(F.col("__revenue") - prev, prev).alias("mom_growth_pct"),
        money(_running()).alias("running_total_aud"),
    )


def rolling_bulk_rate(appointments: DataFrame) -> DataFrame:
    """Bulk-billing rate and its three-month rolling mean."""
    return _monthly(appointments).select(
        "month", round_half_up(F.col("__bulk")).alias("bulk_billing_rate_pct"),
        round_half_up(_rolling()).alias("rolling_3m_avg_pct"),
    )


def no_show_against_average(appointments: DataFrame) -> DataFrame:
    """Missed share per specialty beside the plain mean of the specialties."""
    rows = appointments.groupBy("specialty").agg(
        F.count("*").alias("total_appointments"),
        F.count_if(missed()).alias("no_shows"),
        pct(F.count_if(missed()), F.count("*")).alias("__rate"),
    )
    overall = rows.agg(F.avg("__rate").alias("__avg"))
    return with_scalars(rows, overall).select(
        "specialty", "total_appointments", "no_shows", round_half_up(F.col("__rate")).alias("no_show_rate_pct"),
        round_half_up(F.col("__avg")).alias("overall_avg_no_show_pct"),
        round_half_up(F.col("__rate") - F.col("__avg")).alias("diff_from_avg_pct"),
    )


def neighbour_months(appointments: DataFrame) -> DataFrame:
    """Monthly revenue with the previous and the next month."""
    revenue = money(F.col("__revenue"))
    return _monthly(appointments).select(
        "month", revenue.alias("monthly_revenue"),
        F.lag(revenue).over(_months()).alias("prev_month_revenue"),
        F.lead(revenue).over(_months()).alias("next_month_revenue"),
    )


def running_and_rolling(appointments: DataFrame) -> DataFrame:
    """Running revenue and rolling bulk rate together."""
    return _monthly(appointments).select(
        "month", money(F.col("__revenue")).alias("monthly_revenue"), money(_running()).alias("running_total_aud"),
        round_half_up(_rolling()).alias("rolling_3m_bulk_billing_pct"),
    )


def patient_pareto(patients: DataFrame) -> DataFrame:
    """Percentile of lifetime value and cumulative share of revenue, largest first (ties by id).

    One ascending pass serves both: counted from the top, the running sum is the total minus the
    ascending running sum plus the row itself.
    """
    people = patients.select("patient_id", "total_billed")
    ranked = ordered_measures(
        people, [], "total_billed", "patient_id", tie_desc=True, rank="__rank",
        running={"__ascending": "total_billed"},
    )
    totals = people.agg(F.sum("total_billed").alias("__total"), F.count("*").alias("__n"))
    from_top = F.col("__total") - F.col("__ascending") + F.col("total_billed")
    percentile = F.coalesce(pct(F.col("__rank") - 1, F.col("__n") - 1), F.lit(0.0))
    return with_scalars(ranked, totals).select(
        "patient_id", money(F.col("total_billed")).alias("lifetime_billed_aud"),
        round_half_up(percentile).alias("percentile"),
        rate_pct(from_top, F.col("__total")).alias("cumulative_revenue_pct"),
    )


def patient_ranks(patients: DataFrame) -> DataFrame:
    """Row number, rank and dense rank of lifetime value within the state (ties by id)."""
    people = patients.select("patient_id", "state", "total_billed")
    return ordered_measures(
        people, ["state"], "total_billed", "patient_id", value_desc=True, row_number="row_number", rank="rank",
        dense_rank="dense_rank",
    ).withColumnRenamed("total_billed", "lifetime_billed_aud")


def patient_rank_and_pareto(patients: DataFrame) -> DataFrame:
    """Rank in state, overall percentile and cumulative revenue share."""
    in_state = ordered_measures(
        patients.select("patient_id", "state", "total_billed"), ["state"], "total_billed", "patient_id",
        value_desc=True, rank="rank_in_state",
    ).select("patient_id", "rank_in_state")
    profile = patients.select("patient_id", "state", "insurance_type", "churn_flag")
    return profile.join(in_state, "patient_id").join(patient_pareto(patients), "patient_id")


def patient_journey(appointments: DataFrame, with_billed: bool = True) -> DataFrame:
    """W5 (and W10 without the billed amount): visit number, first and last visit, running total."""
    columns = ["patient_id", "appointment_date", "specialty", "billing_type", "status", "billed_amount"]
    rows = appointments.select("appointment_id", *columns).withColumn(
        "__billed", F.when(done(), F.col("billed_amount")).otherwise(0)
    )
    numbered = ordered_measures(
        rows, ["patient_id"], "appointment_date", "appointment_id",
        then_by=["specialty", "billing_type", "status", "billed_amount"], row_number="__number",
        running={"__running": "__billed"}, ends=("__first", "__last"),
    )
    if with_billed:
        return numbered.select(
            *columns, F.col("__first").alias("first_appointment_date"), F.col("__last").alias("latest_appointment_date"),
            F.col("__number").alias("appointment_number"), money(F.col("__running")).alias("running_patient_total_aud"),
        )
    return numbered.select(
        *columns[:-1], F.col("__first").alias("first_visit_date"), F.col("__last").alias("latest_visit_date"),
        F.col("__number").alias("visit_number"), money(F.col("__running")).alias("running_patient_total_aud"),
    )
