"""Specialty, clinic and channel scorecards.

Satisfaction comes from a narrow inner join of surveys (one row per visit) with the visit's key and
group only, so the wide fact rows are aggregated without ever being shuffled by visit id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.exprs import (
    done,
    mean,
    mean_if,
    missed,
    money,
    month_of,
    pct,
    rate_pct,
    ratio,
    round_half_up,
    sum_if,
    with_scalars,
)
from .kpis import CLINIC, clinic_rollup, is_bulk


def surveys_per_visit(surveys: DataFrame) -> DataFrame:
    return surveys.groupBy("appointment_id").agg(
        F.sum("overall_score").alias("__score_sum"), F.count("overall_score").alias("__score_n")
    )


def satisfaction_by(appointments: DataFrame, surveys: DataFrame, keys: list[str]) -> DataFrame:
    """Mean survey score per group of visits."""
    scored = appointments.select("appointment_id", *keys).join(surveys_per_visit(surveys), "appointment_id")
    return scored.groupBy(*keys).agg(
        round_half_up(F.try_divide(F.sum("__score_sum").cast("double"), F.sum("__score_n").cast("double")))
        .alias("avg_satisfaction")
    )


def specialty_scorecard(appointments: DataFrame, surveys: DataFrame) -> DataFrame:
    """Volume, price, cost, margin, wait, bulk share and satisfaction per specialty."""
    margin = F.col("billed_amount") - F.col("staff_cost")
    card = appointments.groupBy("specialty").agg(
        F.count_if(done()).alias("completed_appointments"),
        round_half_up(mean_if(done(), "billed_amount")).alias("avg_billed_aud"),
        round_half_up(mean_if(done(), "staff_cost")).alias("avg_cost_aud"),
        round_half_up(mean_if(done(), margin)).alias("avg_margin_aud"),
        rate_pct(mean_if(done(), margin), mean_if(done(), "billed_amount")).alias("margin_pct"),
        round_half_up(mean_if(done(), "wait_days"), 1).alias("avg_wait_days"),
        rate_pct(F.count_if(done() & is_bulk()), F.count_if(done())).alias("bulk_billing_rate_pct"),
    )
    return card.join(satisfaction_by(appointments, surveys, ["specialty"]), "specialty", "left")


def specialty_scorecard_view(appointments: DataFrame, surveys: DataFrame) -> DataFrame:
    """V4: the shorter scorecard; wait over every status."""
    margin = F.col("billed_amount") - F.col("staff_cost")
    card = appointments.groupBy("specialty").agg(
        F.count_if(done()).alias("completed_appointments"),
        round_half_up(mean_if(done(), "billed_amount")).alias("avg_billed_aud"),
        round_half_up(mean_if(done(), margin)).alias("avg_margin_aud"),
        rate_pct(mean_if(done(), margin), mean_if(done(), "billed_amount")).alias("margin_pct"),
        round_half_up(mean("wait_days"), 1).alias("avg_wait_days"),
    )
    return card.join(satisfaction_by(appointments, surveys, ["specialty"]), "specialty", "left")


def clinic_ranking(staff: DataFrame, appointments: DataFrame, with_avg: bool = True) -> DataFrame:
    """A10 (and V5 without the average): visits, patients, revenue and rates per clinic."""
    rollup = clinic_rollup(staff, appointments, {
        "__done": F.count_if(done()), "__missed": F.count_if(missed()), "__billed": sum_if(done(), "billed_amount"),
    })
    average = [round_half_up(ratio(F.col("__billed"), F.col("__done"))).alias("avg_billed_aud")] if with_avg else []
    return rollup.select(
        *CLINIC,
        F.col("visits").alias("appointments" if with_avg else "total_appointments"),
        F.col("people").alias("unique_patients"),
        money(F.coalesce("__billed", F.lit(0))).alias("total_revenue_aud"),
        *average,
        rate_pct(F.coalesce("__missed", F.lit(0)), F.col("visits")).alias("no_show_rate_pct"),
        "avg_staff_rating",
    )


def telehealth_comparison(appointments: DataFrame, surveys: DataFrame) -> DataFrame:
    """Completed visits by month and type with price, revenue, satisfaction and wait."""
    rows = appointments.filter(done()).withColumn("month", month_of("appointment_date"))
    keys = ["month", "appointment_type"]
    table = rows.groupBy(*keys).agg(
        F.count("*").alias("completed"),
        round_half_up(mean("billed_amount")).alias("avg_billed_aud"),
        money(F.sum("billed_amount")).alias("total_revenue_aud"),
        round_half_up(mean("wait_days"), 1).alias("avg_wait_days"),
    )
    return table.join(satisfaction_by(rows, surveys, keys), keys, "left")


def above_network_no_show(appointments: DataFrame) -> DataFrame:
    """G1: specialties that miss more visits than the network does."""
    raw = pct(F.count_if(missed()), F.count("*"))
    network = appointments.agg(raw.alias("__network"))
    rows = appointments.groupBy("specialty").agg(F.count("*").alias("total_appointments"), raw.alias("__rate"))
    return with_scalars(rows, network).filter("__rate > __network").select(
        "specialty", "total_appointments", round_half_up(F.col("__rate")).alias("no_show_rate_pct")
    )
