"""Where billed money leaks, month by month and by bucket, and what could be recovered.

Every bucket of a table comes from one conditional aggregate over it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.exprs import (
    as_rows,
    done,
    has_status,
    in_months,
    missed,
    money,
    month_of,
    normalised,
    rate_pct,
    ratio,
    round_half_up,
    sum_if,
    top_value,
    with_scalars,
)
from .kpis import is_bulk

# Accepted spellings, bucket names, recovery shares.
PRIVATE_NAMES = ["private_insurance", "private insurance", "private"]
SELF_PAY_NAMES = ["self_pay", "self pay", "selfpay"]
BUCKETS = [
    ("medicare", "Bucket 1: Medicare Rejections", "Medicare Rejections"),
    ("private", "Bucket 2: Private Ins. Reject/Partial", "Private Ins. Reject/Partial"),
    ("no_show", "Bucket 3: No-Show Loss", "No-Show Loss"),
    ("self_pay", "Bucket 4: Self-Pay Defaults", "Self-Pay Defaults"),
    ("erosion", "Bucket 5: Bulk Bill Erosion", "Bulk Bill Erosion"),
]
SCENARIOS = [("Conservative (20% fix)", 0.20), ("Moderate (50% fix)", 0.50), ("Aggressive (75% fix)", 0.75)]
EROSION_SHARE = 0.30


def _rejected() -> Column:
    return has_status("rejected", column="claim_status")


def medicare_rejections(claims: DataFrame) -> DataFrame:
    """Medicare claims by month: rejected count, rate, value and the commonest reason."""
    rows = claims.filter(F.col("claim_type") == "Medicare").withColumn("month", month_of("claim_date"))
    table = rows.groupBy("month").agg(
        F.count("*").alias("total_claims"),
        F.count_if(_rejected()).alias("rejected"),
        rate_pct(F.count_if(_rejected()), F.count("*")).alias("rejection_rate_pct"),
        money(sum_if(_rejected(), "rejected_amount")).alias("rejected_value_aud"),
    )
    return table.join(top_value(rows, ["month"], "rejection_reason", "top_rejection_reason"), "month", "left")


def no_show_loss(appointments: DataFrame, fill_rate: str = "0.70") -> DataFrame:
    """Fees lost to missed visits by month and specialty, and the recoverable part."""
    lost = sum_if(missed(), "scheduled_fee")
    return appointments.groupBy(month_of("appointment_date").alias("month"), "specialty").agg(
        F.count_if(missed()).alias("no_shows"),
        money(lost).alias("lost_revenue_aud"),
        money(lost * F.lit(fill_rate).cast("decimal(4,2)")).alias("recoverable_at_70pct"),
    )


def claims_by_type(claims: DataFrame) -> DataFrame:
    """Claims, rejections, value, rate and the commonest reason per claim type."""
    table = claims.groupBy("claim_type").agg(
        F.count("*").alias("total_claims"),
        F.count_if(_rejected()).alias("rejected_count"),
        money(sum_if(_rejected(), "rejected_amount")).alias("total_rejected_aud"),
        rate_pct(F.count_if(_rejected()), F.count("*")).alias("rejection_rate_pct"),
    )
    return table.join(top_value(claims, ["claim_type"], "rejection_reason", "top_rejection_reason"),
                      "claim_type", "left")


def leakage_report(claims: DataFrame, month: str) -> DataFrame:
    """One month's rejected value, rejection rate over all its claims and commonest reason.

    The month becomes a range on ``claim_date``, which reaches the scan, and on the ``month`` partitions
    of a saved table.
    """
    first = F.trunc(F.lit(month).cast("date"), "MM")
    rows = in_months(claims, first, first).filter((F.col("claim_date") >= first) & (F.col("claim_date") < F.add_months(first, 1)))
    rejected = rows.filter(_rejected())
    reasons = (
        rejected.filter("rejection_reason IS NOT NULL AND rejection_reason <> 'None'")
        .groupBy("rejection_reason")
        .agg(F.count("*").alias("__n"))
        .agg(F.min_by("rejection_reason", F.struct((-F.col("__n")).alias("n"), "rejection_reason"))
             .alias("top_rejection_reason"))
    )
    totals = rows.agg(
        F.max(F.date_format(first, "MMMM yyyy")).alias("month_label"),
        money(F.sum(F.when(_rejected(), F.col("rejected_amount")))).alias("total_rejected_aud"),
        rate_pct(F.count_if(_rejected()), F.count("*")).alias("rejection_rate_pct"),
    )
    return with_scalars(totals, reasons)


def baselines(appointments: DataFrame, claims: DataFrame) -> DataFrame:
    """L0: gross revenue, scheduled fees and claimed value."""
    visits = appointments.agg(
        money(sum_if(done(), "billed_amount")).alias("gross_revenue"),
        money(F.sum("scheduled_fee")).alias("total_scheduled"),
    )
    return with_scalars(visits, claims.agg(money(F.sum("claimed_amount")).alias("total_claimed")))


def bucket_totals(appointments: DataFrame, claims: DataFrame, split_after: int = 6) -> DataFrame:
    """L1 to L5 as one row: amount and row count of every bucket, plus gross revenue."""
    kind, status = normalised("claim_type"), normalised("claim_status")
    medicare = (kind == "medicare") & (status == "rejected")
    private = kind.isin(PRIVATE_NAMES) & status.isin("rejected", "partial")
    unpaid = kind.isin(SELF_PAY_NAMES) & (status == "unpaid")
    of_claims = claims.agg(
        sum_if(medicare, "rejected_amount").cast("double").alias("medicare"),
        F.count_if(medicare).alias("medicare_n"),
        sum_if(private, "rejected_amount").cast("double").alias("private"),
        F.count_if(private).alias("private_n"),
        sum_if(unpaid, "claimed_amount").cast("double").alias("self_pay"),
        F.count_if(unpaid).alias("self_pay_n"),
    )
    # One pass over the visits; months are numbered on the few rows that are left.
    fee = F.when(done(), F.col("scheduled_fee"))
    monthly = appointments.groupBy(month_of("appointment_date").alias("__month")).agg(
        sum_if(done(), "billed_amount").alias("__gross"), sum_if(missed(), "scheduled_fee").alias("__lost"),
        F.count_if(missed()).alias("__missed"), F.count_if(done()).alias("__done"),
        F.count_if(done() & is_bulk()).alias("__bulk"), F.sum(fee).alias("__fees"), F.count(fee).alias("__fee_n"),
    )
    first = F.min("__month").over(Window.partitionBy())
    number = F.months_between("__month", first).cast("int") + 1
    numbered = monthly.withColumn("month_num", number)
    early, late = F.col("month_num") <= split_after, F.col("month_num") > split_after
    of_visits = numbered.agg(
        F.coalesce(F.sum("__gross"), F.lit(0)).cast("double").alias("gross"),
        F.coalesce(F.sum("__lost"), F.lit(0)).cast("double").alias("no_show"),
        F.coalesce(F.sum("__missed"), F.lit(0)).alias("no_show_n"),
        F.coalesce(ratio(sum_if(early, "__bulk"), sum_if(early, "__done")), F.lit(0.0)).alias("rate_early"),
        F.coalesce(ratio(sum_if(late, "__bulk"), sum_if(late, "__done")), F.lit(0.0)).alias("rate_late"),
        sum_if(late, "__done").alias("late_n"),
        F.coalesce(ratio(F.sum("__fees"), F.sum("__fee_n")), F.lit(0.0)).alias("avg_fee"),
    )
    drop = F.greatest(F.col("rate_early") - F.col("rate_late"), F.lit(0.0))
    erosion = drop * F.col("late_n") * F.col("avg_fee") * F.lit(EROSION_SHARE)
    return with_scalars(of_visits.withColumn("erosion", erosion), of_claims)


def bulk_erosion(appointments: DataFrame, claims: DataFrame) -> DataFrame:
    """L5 on its own: rates before and after the split and the estimated loss."""
    return bucket_totals(appointments, claims).select(
        round_half_up(F.col("rate_early") * 100).alias("rate_early_pct"),
        round_half_up(F.col("rate_late") * 100).alias("rate_late_pct"),
        F.col("late_n").alias("late_appointments"), round_half_up(F.col("avg_fee")).alias("avg_scheduled_fee"),
        round_half_up(F.col("erosion"), 4).alias("erosion"),
    )


def bucket_counts(appointments: DataFrame, claims: DataFrame) -> DataFrame:
    """L1 to L4: amount and number of rows behind each counted bucket."""
    totals = bucket_totals(appointments, claims)
    return as_rows(totals, ["bucket", "leakage_amount", "n"], [
        [F.lit(label), round_half_up(F.col(key)), F.col(f"{key}_n")] for key, label, _ in BUCKETS[:4]
    ])


def _total_leakage() -> Column:
    amounts = [F.col(key) for key, _, _ in BUCKETS]
    return sum(amounts[1:], amounts[0])


def summarise(totals: DataFrame) -> DataFrame:
    """L6 from a one-row bucket frame: bucket, amount and share of gross revenue."""
    gross = F.col("gross")
    return as_rows(totals, ["bucket", "leakage_amount", "pct_of_gross"], [
        [F.lit(label), round_half_up(F.col(key), 4),
         F.when(gross > 0, rate_pct(F.col(key), gross, 6)).otherwise(F.lit(0.0))]
        for key, label, _ in BUCKETS
    ])


def leakage_summary(appointments: DataFrame, claims: DataFrame) -> DataFrame:
    """The five buckets with their share of gross revenue."""
    return summarise(bucket_totals(appointments, claims))


def leakage_bridge(appointments: DataFrame, claims: DataFrame) -> DataFrame:
    """Gross revenue, each bucket taken off in turn, realised revenue, with the level reached."""
    totals = bucket_totals(appointments, claims)
    level = F.col("gross")
    rows = [[F.lit(1), F.lit("Gross Revenue"), round_half_up(level), round_half_up(level)]]
    for i, (key, label, _) in enumerate(BUCKETS):
        level = level - F.col(key)
        rows.append([F.lit(i + 2), F.lit(label), round_half_up(-F.col(key)), round_half_up(level)])
    rows.append([F.lit(len(BUCKETS) + 2), F.lit("Realized Revenue"), round_half_up(level), round_half_up(level)])
    return as_rows(totals, ["step", "label", "amount", "level"], rows)


def monthly_leakage(appointments: DataFrame, claims: DataFrame) -> DataFrame:
    """Missed-visit loss and refused claims per month over the months of either table."""
    visits = appointments.groupBy(month_of("appointment_date").alias("month")).agg(
        money(sum_if(missed(), "scheduled_fee")).alias("__lost")
    )
    refused = normalised("claim_status").isin("rejected", "partial")
    money_back = claims.groupBy(month_of("claim_date").alias("month")).agg(
        money(sum_if(refused, "rejected_amount")).alias("__refused")
    )
    lost, back = F.coalesce("__lost", F.lit(0)), F.coalesce("__refused", F.lit(0))
    return visits.join(money_back, "month", "full").select(
        "month", lost.alias("no_show_loss"), back.alias("rejected_claims"),
        (lost + back).alias("total_leakage_monthly"),
    )


def recovery_rows(appointments: DataFrame, claims: DataFrame) -> DataFrame:
    """Every scenario applied to every bucket, 15 rows."""
    totals = bucket_totals(appointments, claims)
    return as_rows(totals, ["scenario", "bucket", "recovery"], [
        [F.lit(name), F.lit(short), round_half_up(F.col(key) * F.lit(share), 4)]
        for name, share in SCENARIOS for key, _, short in BUCKETS
    ])


def recovery_scenarios(appointments: DataFrame, claims: DataFrame) -> DataFrame:
    """L9 as a table: bucket by scenario."""
    names = [name for name, _ in SCENARIOS]
    return recovery_rows(appointments, claims).groupBy("bucket").pivot("scenario", names).agg(F.max("recovery"))


def recovery_totals(appointments: DataFrame, claims: DataFrame) -> DataFrame:
    """Recovery per scenario over all buckets."""
    totals = bucket_totals(appointments, claims)
    return as_rows(totals, ["scenario", "total_recovery"], [
        [F.lit(name), round_half_up(_total_leakage() * F.lit(share))] for name, share in SCENARIOS
    ])


def leakage_headline(appointments: DataFrame, claims: DataFrame) -> DataFrame:
    """Gross, total leakage, its share, realised revenue and the moderate recovery."""
    total = _total_leakage()
    return bucket_totals(appointments, claims).select(
        round_half_up(F.col("gross")).alias("gross_revenue"),
        round_half_up(total).alias("total_leakage"),
        rate_pct(total, F.col("gross"), 1).alias("leakage_pct"),
        round_half_up(F.col("gross") - total).alias("realised_revenue"),
        round_half_up(total * 0.5).alias("moderate_recovery"),
        rate_pct(total * 0.5, F.col("gross"), 1).alias("moderate_gain_pct"),
    )
