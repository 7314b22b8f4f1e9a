"""Profit per specialty and clinic, with waits and satisfaction beside it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.exprs import (
    as_rows,
    done,
    mean,
    missed,
    money,
    pct,
    ratio,
    round_half_up,
    sum_if,
    with_scalars,
)
from .kpis import band, extreme_row, is_bulk
from .scorecards import satisfaction_by, surveys_per_visit


def completed_with_clinic(appointments: DataFrame, staff: DataFrame) -> DataFrame:
    """Completed visits with their clinic, category taken from staff when missing, and margin."""
    clinics = staff.select(
        "staff_id", F.col("specialty").alias("__staff_specialty"), "clinic_name", "state", "clinic_type"
    )
    margin = F.col("billed_amount") - F.col("staff_cost")
    return (
        appointments.filter(done())
        .join(clinics, "staff_id", "left")
        .withColumn("specialty", F.coalesce("specialty", "__staff_specialty"))
        .drop("__staff_specialty")
        .withColumn("margin", margin)
        .withColumn(
            "margin_pct",
            F.when(F.col("billed_amount") > 0, pct(F.col("margin"), F.col("billed_amount"))).otherwise(F.lit(0.0)),
        )
    )


def specialty_profit(appointments: DataFrame, staff: DataFrame | None = None) -> DataFrame:
    """Profit and loss per specialty, with wait and missed share over every status.

    One pass: visits are summed per (specialty, staff), the missing categories are filled from
    staff on that small result, and the sums are added up per specialty.
    """
    keys = ["specialty"] if staff is None else ["specialty", "staff_id"]
    sums = appointments.groupBy(*keys).agg(
        F.count("*").alias("__all"),
        F.count_if(missed()).alias("__missed"),
        F.sum("wait_days").alias("__wait"),
        F.count("wait_days").alias("__waits"),
        F.count_if(done()).alias("__done"),
        F.count_if(done() & is_bulk()).alias("__bulk"),
        sum_if(done(), "billed_amount").alias("__billed"),
        sum_if(done(), "staff_cost").alias("__cost"),
    )
    if staff is not None:
        own = staff.select("staff_id", F.col("specialty").alias("__staff_specialty"))
        sums = sums.join(own, "staff_id", "left").withColumn(
            "specialty", F.coalesce("specialty", "__staff_specialty")
        )
    measures = ["__all", "__missed", "__wait", "__waits", "__done", "__bulk", "__billed", "__cost"]
    table = sums.filter("specialty IS NOT NULL").groupBy("specialty").agg(*[F.sum(m).alias(m) for m in measures])
    done_n, billed, cost = F.col("__done"), F.col("__billed"), F.col("__cost")
    profit = billed - cost
    return table.filter("__done > 0").select(
        "specialty",
        done_n.alias("completed_appointments"),
        round_half_up(ratio(billed, done_n), 6).alias("avg_billed"),
        round_half_up(ratio(cost, done_n), 6).alias("avg_cost"),
        round_half_up(ratio(profit, done_n), 6).alias("avg_margin"),
        money(billed).alias("total_revenue"),
        money(cost).alias("total_cost"),
        money(profit).alias("total_profit"),
        F.col("__bulk").alias("bulk_bill_count"),
        round_half_up(pct(profit, billed), 6).alias("margin_pct"),
        round_half_up(pct(F.col("__bulk"), done_n), 6).alias("bulk_billing_rate"),
        round_half_up(ratio(F.col("__wait"), F.col("__waits")), 6).alias("avg_wait_days"),
        round_half_up(pct(F.col("__missed"), F.col("__all")), 6).alias("no_show_rate"),
    )


def margin_bands(profit: DataFrame) -> DataFrame:
    """Margin per visit as high (over 30), mid (over 15) or low."""
    return profit.select(
        "specialty", "avg_margin", band(F.col("avg_margin"), (30, "high"), (15, "mid"), otherwise="low").alias("band")
    )


def wait_against_satisfaction(appointments: DataFrame, surveys: DataFrame) -> DataFrame:
    """Average wait and survey score per specialty with the least-squares line through them."""
    waits = appointments.groupBy("specialty").agg(
        round_half_up(mean("wait_days"), 6).alias("avg_wait_days"),
        F.count_if(done()).alias("completed_appointments"),
    )
    points = waits.join(satisfaction_by(appointments, surveys, ["specialty"]), "specialty").withColumnRenamed(
        "avg_satisfaction", "avg_overall_score"
    )
    x, y = "avg_wait_days", "avg_overall_score"
    line = points.agg(
        round_half_up(F.regr_slope(y, x), 6).alias("slope"),
        round_half_up(F.regr_intercept(y, x), 6).alias("intercept"),
        round_half_up(F.corr(y, x), 6).alias("correlation"),
    )
    return with_scalars(points, line)


def clinic_performance(appointments: DataFrame, staff: DataFrame, surveys: DataFrame) -> DataFrame:
    """T4: completed visits, revenue, wait and survey score per clinic and state."""
    rows = appointments.filter(done())
    clinics = staff.select("staff_id", "clinic_name", "state")
    per_staff = rows.groupBy("staff_id").agg(
        F.count("*").alias("__n"), F.sum("billed_amount").alias("__billed"),
        F.sum("wait_days").alias("__wait"), F.count("wait_days").alias("__waits"),
    )
    scored = rows.select("appointment_id", "staff_id").join(surveys_per_visit(surveys), "appointment_id")
    score = scored.groupBy("staff_id").agg(
        F.sum("__score_sum").alias("__score_sum"), F.sum("__score_n").alias("__score_n")
    )
    return (
        clinics.join(per_staff, "staff_id").join(score, "staff_id", "left")
        .groupBy("clinic_name", "state")
        .agg(
            F.sum("__n").alias("total_appointments"),
            money(F.sum("__billed")).alias("total_revenue"),
            round_half_up(ratio(F.sum("__wait"), F.sum("__waits")), 6).alias("avg_wait_days"),
            round_half_up(ratio(F.sum("__score_sum"), F.sum("__score_n"))).alias("avg_satisfaction"),
        )
    )


def wait_proxy(performance: DataFrame) -> DataFrame:
    """T4, optional column: satisfaction guessed from the wait, 5 for the shortest down to 3."""
    w = F.col("avg_wait_days")
    ends = performance.agg(F.min(w).alias("__min"), F.max(w).alias("__max"))
    scaled = (w - F.col("__min")) / (F.col("__max") - F.col("__min") + F.lit(1e-9))
    return with_scalars(performance, ends).withColumn(
        "satisfaction_proxy", round_half_up(F.lit(5.0) - scaled * 2.0, 6)
    ).drop("__min", "__max")


def best_and_worst(profit: DataFrame) -> DataFrame:
    """T5: highest margin, lowest margin and longest wait."""
    best = extreme_row(profit, "specialty", "margin_pct", largest=True, prefix="highest_margin")
    worst = extreme_row(profit, "specialty", "margin_pct", largest=False, prefix="lowest_margin")
    wait = extreme_row(profit, "specialty", "avg_wait_days", largest=True, prefix="longest_wait")
    wide = with_scalars(with_scalars(best, worst), wait)
    names = ["highest_margin", "lowest_margin", "longest_wait"]
    return as_rows(wide, ["finding", "specialty", "value"],
                   [[F.lit(n), F.col(n), F.col(f"{n}_value")] for n in names])


def margin_chart(appointments: DataFrame) -> DataFrame:
    """Mean margin, revenue and mean of the visits' own margin shares, with a band.

    Row shares are added as DECIMAL, so the sum is the same however rows are partitioned.
    """
    margin = F.col("billed_amount") - F.col("staff_cost")
    share = ratio(margin, F.col("billed_amount")).cast("decimal(28,10)")
    return (
        appointments.filter(done())
        .groupBy("specialty")
        .agg(
            round_half_up(mean(margin)).alias("avg_margin"),
            money(F.sum("billed_amount")).alias("total_revenue"),
            round_half_up(mean(share) * 100).alias("margin_pct"),
        )
        .withColumn("band", band(F.col("margin_pct"), (50, "green"), (25, "orange"), otherwise="red"))
    )
