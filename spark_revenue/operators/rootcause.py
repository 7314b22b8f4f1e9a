"""Why revenue moved: monthly growth, month-pair decomposition, billing-mix bridge, erosion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.exprs import (
    as_rows,
    done,
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
from .kpis import is_bulk


def monthly_kpis(appointments: DataFrame) -> DataFrame:
    """A1, the month table: volumes, revenue, average and rates."""
    return appointments.groupBy(month_of("appointment_date").alias("month")).agg(
        F.count_if(done()).alias("completed"),
        F.count_if(missed()).alias("no_shows"),
        money(sum_if(done(), "billed_amount")).alias("gross_revenue"),
        round_half_up(mean_if(done(), "billed_amount")).alias("avg_billed"),
        rate_pct(F.count_if(done() & is_bulk()), F.count_if(done())).alias("bulk_billing_rate_pct"),
        rate_pct(F.count_if(missed()), F.count("*")).alias("no_show_rate_pct"),
    )


def monthly_growth(appointments: DataFrame) -> DataFrame:
    """A1: the month table with the previous month and the growth. The window sees one row a month."""
    by_month = Window.orderBy("month")
    return (
        monthly_kpis(appointments)
        .withColumn("prev_month_revenue", F.lag("gross_revenue").over(by_month))
        .withColumn(
            "mom_revenue_growth_pct",
            rate_pct(F.col("gross_revenue") - F.col("prev_month_revenue"), F.col("prev_month_revenue")),
        )
    )


def month_pair_effects(appointments: DataFrame, later: str | None = None,
                       dates: DataFrame | None = None) -> DataFrame:
    """A2 and A2m: last two months per specialty, revenue change split into volume, rate and mix.

    One filtered pass with conditional aggregates gives the same rows as two aggregates joined full
    outer.  ``later`` is the first day of the later month, by default the last month in the data,
    read from ``dates`` (a narrow frame of the same visits) where that is given.
    """
    last = (appointments if dates is None else dates).agg(
        (F.lit(later).cast("date") if later else F.trunc(F.max("appointment_date"), "MM")).alias("__m7")
    )
    month = month_of("appointment_date")
    in_m7, in_m6 = F.col("__month") == F.col("__m7"), F.col("__month") == F.add_months("__m7", -1)
    rows = with_scalars(appointments, last).withColumn("__month", month).filter(in_m7 | in_m6)

    def side(cond: Column, name: str) -> list[Column]:
        hit = cond & done()
        return [
            F.count_if(hit).alias(f"{name}_volume"),
            F.coalesce(round_half_up(mean_if(hit, "billed_amount")), F.lit(0.0)).alias(f"{name}_avg_rate"),
            money(sum_if(hit, "billed_amount")).alias(f"{name}_revenue"),
        ]

    volume = (F.col("m7_volume") - F.col("m6_volume")) * F.col("m6_avg_rate")
    rate = F.col("m6_volume") * (F.col("m7_avg_rate") - F.col("m6_avg_rate"))
    delta = F.col("m7_revenue") - F.col("m6_revenue")
    return rows.groupBy("specialty").agg(*side(in_m6, "m6"), *side(in_m7, "m7")).select(
        "*",
        delta.alias("revenue_delta"),
        round_half_up(volume).alias("volume_effect"),
        round_half_up(rate).alias("rate_effect"),
        round_half_up(delta.cast("double") - volume - rate).alias("mix_effect"),
    )


def erosion_by_month(appointments: DataFrame, months_back: int = 3) -> DataFrame:
    """Revenue lost per month against the bulk-billing rate of the earlier months.

    The baseline is the mean of the monthly rates before (last month - ``months_back``).
    """
    monthly = appointments.groupBy(month_of("appointment_date").alias("month")).agg(
        F.count_if(done()).alias("completed"),
        F.count_if(done() & is_bulk()).alias("bulk_billed"),
        round_half_up(mean_if(done(), "billed_amount")).alias("__fee"),
    )
    rate = ratio(F.col("bulk_billed"), F.col("completed"))
    # Windows over the month rows, of which there are few, rather than the visits read again.
    every = Window.partitionBy()
    cutoff = F.add_months(F.max("month").over(every), -months_back)
    # Rates to twelve decimals as DECIMAL: their sum does not depend on the order of the rows.
    fixed = F.when(F.col("month") < F.col("__cutoff"), rate.cast("decimal(16,12)"))
    base = F.try_divide(F.sum(fixed).over(every).cast("double"), F.count(fixed).over(every).cast("double"))
    lost = F.greatest(F.lit(0.0), F.col("__base") - rate) * F.col("completed") * F.col("__fee")
    return monthly.withColumn("__cutoff", cutoff).withColumn("__base", base).select(
        "month", "completed", "bulk_billed",
        rate_pct(F.col("bulk_billed"), F.col("completed")).alias("actual_bb_rate_pct"),
        round_half_up(F.col("__base") * 100).alias("baseline_bb_rate_pct"),
        round_half_up(F.when(rate.isNotNull(), lost)).alias("erosion_cost_aud"),
    )


_METRICS = [
    "total_appts", "completed_appts", "total_revenue", "avg_billed", "bulk_bill_rate", "noshow_rate", "avg_wait_days",
]


def _pair_stats(numbered: DataFrame, first: int, second: int, *more: Column) -> DataFrame:
    """One row with the seven metrics of both months (suffixes _a and _b), and more over both."""
    out = []
    for suffix, number in (("a", first), ("b", second)):
        here = F.col("month_num") == number
        hit = here & done()
        total = F.count_if(here)
        values = [
            total.cast("double"),
            F.count_if(hit).cast("double"),
            sum_if(hit, "billed_amount").cast("double"),
            F.coalesce(mean_if(hit, "billed_amount"), F.lit(0.0)),
            pct(F.count_if(here & is_bulk()), total),
            pct(F.count_if(here & missed()), total),
            mean_if(here, "wait_days"),
        ]
        out += [v.alias(f"{m}_{suffix}") for m, v in zip(_METRICS, values)]
    return numbered.filter(F.col("month_num").isin(first, second)).agg(*out, *more)


def month_comparison(numbered: DataFrame, first: int = 6, second: int = 7) -> DataFrame:
    """Seven metrics of two months as rows with change and relative change."""
    rows = []
    for i, metric in enumerate(_METRICS):
        a, b = F.col(f"{metric}_a"), F.col(f"{metric}_b")
        rows.append([
            F.lit(i + 1), F.lit(metric), round_half_up(a, 4), round_half_up(b, 4), round_half_up(b - a, 4),
            rate_pct(b - a, F.abs(a), 1),
        ])
    return as_rows(
        _pair_stats(numbered, first, second), ["position", "metric", "first", "second", "delta", "delta_pct"], rows
    )


def revenue_bridge(numbered: DataFrame, first: int = 6, second: int = 7) -> DataFrame:
    """Baseline, volume effect, billing-mix shift, residual and actual revenue."""
    stats = _pair_stats(
        numbered, first, second,
        mean_if(done() & is_bulk(), "billed_amount").alias("__bulk"),
        mean_if(done() & (F.col("billing_type") == "private"), "billed_amount").alias("__private"),
        mean_if(done() & (F.col("billing_type") == "gap_payment"), "billed_amount").alias("__gap"),
    )
    bulk = F.coalesce("__bulk", F.lit(0.0))
    private = F.coalesce(F.col("__private"), F.col("__gap"), bulk)
    shift = (F.col("bulk_bill_rate_b") - F.col("bulk_bill_rate_a")) / 100
    effects = stats.select(
        "total_revenue_a", "total_revenue_b",
        ((F.col("completed_appts_b") - F.col("completed_appts_a")) * F.col("avg_billed_a")).alias("volume"),
        (shift * F.col("completed_appts_b") * (bulk - private)).alias("rate"),
    )
    residual = F.col("total_revenue_b") - F.col("total_revenue_a") - F.col("volume") - F.col("rate")
    steps = [
        ("baseline", F.col("total_revenue_a")), ("volume effect", F.col("volume")),
        ("billing rate shift", F.col("rate")), ("mix residual", residual), ("actual", F.col("total_revenue_b")),
    ]
    return as_rows(effects, ["step", "effect", "amount"],
                   [[F.lit(i + 1), F.lit(label), round_half_up(v)] for i, (label, v) in enumerate(steps)])
