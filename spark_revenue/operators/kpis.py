"""Monthly and per-group KPIs.

Every KPI is one pass of conditional aggregates, so Spark combines map-side and only shuffles one
row per group and task, however unequal the groups are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.exprs import (
    COMPLETED,
    done,
    has_status,
    is_complaint,
    mean,
    mean_if,
    missed,
    money,
    month_of,
    normalised,
    pct,
    rate_pct,
    ratio,
    round_half_up,
    sum_if,
    with_scalars,
)
from ..schema import BILLING_TYPES

# Words that mark a remote visit.
REMOTE_WORDS = ["telehealth", "tele", "virtual", "remote", "online"]


def _by_month(df: DataFrame, date: str = "appointment_date") -> DataFrame:
    return df.withColumn("month", month_of(date))


def is_bulk() -> Column:
    return F.col("billing_type") == "bulk_bill"


def monthly_revenue(appointments: DataFrame) -> DataFrame:
    """K1: completed, missed, gross revenue and revenue per billing type, by month.

    Rows are summed once per (month, type); the columns are picked from that small table.
    """
    per_type = _by_month(appointments).groupBy("month", "billing_type").agg(
        F.count_if(done()).alias("__done"),
        F.count_if(missed()).alias("__missed"),
        sum_if(done(), "billed_amount").alias("__billed"),
    )
    return per_type.groupBy("month").agg(
        F.sum("__done").alias("completed_appointments"),
        F.sum("__missed").alias("no_shows"),
        money(F.sum("__billed")).alias("gross_revenue"),
        *[money(sum_if(F.col("billing_type") == t, "__billed")).alias(f"{t}_revenue") for t in BILLING_TYPES],
    )


def revenue_pivot(appointments: DataFrame) -> DataFrame:
    """Month by billing type, completed revenue, 0 where a type is absent."""
    return (
        _by_month(appointments.filter(done()))
        .groupBy("month")
        .pivot("billing_type", BILLING_TYPES)
        .agg(money(F.sum("billed_amount")))
        .na.fill(0, BILLING_TYPES)
    )


def revenue_share(appointments: DataFrame) -> DataFrame:
    """The pivot plus the month total and the bulk-billed share of revenue."""
    total = sum((F.col(t) for t in BILLING_TYPES[1:]), F.col(BILLING_TYPES[0]))
    return (
        revenue_pivot(appointments)
        .withColumn("total", total)
        .withColumn("bulk_share_pct", rate_pct(F.col("bulk_bill"), F.col("total")))
    )


def bulk_billing_rate(appointments: DataFrame, denominator: str = "completed") -> DataFrame:
    """K2: bulk-billed share of completed visits by month (``denominator='all'``: of all visits)."""
    total = F.count_if(done()) if denominator == "completed" else F.count("*")
    hit = done() & is_bulk() if denominator == "completed" else is_bulk()
    return (
        _by_month(appointments)
        .groupBy("month")
        .agg(total.alias("total_completed"), F.count_if(hit).alias("bulk_billed"))
        .withColumn("bulk_billing_rate_pct", rate_pct(F.col("bulk_billed"), F.col("total_completed")))
    )


def wait_by_specialty(appointments: DataFrame, status: str | None = COMPLETED, long_wait: int = 30) -> DataFrame:
    """K3: wait profile per specialty; ``status=None`` takes all visits.

    Wait days have few distinct values, so the exact median's value counts stay small.
    """
    rows = appointments if status is None else appointments.filter(has_status(status))
    slow = F.count_if(F.col("wait_days") > long_wait)
    return rows.groupBy("specialty").agg(
        F.count("*").alias("appointments"),
        round_half_up(mean("wait_days"), 1).alias("avg_wait_days"),
        round_half_up(F.median("wait_days"), 1).alias("median_wait_days"),
        F.max("wait_days").alias("max_wait_days"),
        slow.alias("long_wait_count"),
        rate_pct(slow, F.count("*")).alias("long_wait_pct"),
    )


def wait_all_statuses(appointments: DataFrame) -> DataFrame:
    """Mean, median and count of wait over every status."""
    return wait_by_specialty(appointments, status=None).select(
        "specialty", F.col("avg_wait_days").alias("avg_wait"),
        F.col("median_wait_days").alias("median_wait"), F.col("appointments").alias("n_appts"),
    )


def band(value: Column, *steps: tuple[float, str], otherwise: str) -> Column:
    """First label whose threshold the value exceeds."""
    chain = F
    for threshold, label in steps:
        chain = chain.when(value > threshold, label)
    return chain.otherwise(otherwise)


def wait_bands(appointments: DataFrame) -> DataFrame:
    """Completed wait per specialty with a traffic-light band."""
    return (
        appointments.filter(done())
        .groupBy("specialty")
        .agg(mean("wait_days").alias("w"), F.count("*").alias("appts"))
        .select(
            "specialty", round_half_up(F.col("w")).alias("avg_wait"), "appts",
            band(F.col("w"), (30, "red"), (14, "orange"), otherwise="green").alias("band"),
        )
    )


def no_show_by_specialty(appointments: DataFrame) -> DataFrame:
    """K4: missed visits and the fees lost with them, by month and specialty."""
    return _by_month(appointments).groupBy("month", "specialty").agg(
        F.count("*").alias("total_appointments"),
        F.count_if(missed()).alias("no_shows"),
        rate_pct(F.count_if(missed()), F.count("*")).alias("no_show_rate_pct"),
        money(sum_if(missed(), "scheduled_fee")).alias("lost_revenue"),
    )


def no_show_trend(numbered: DataFrame) -> DataFrame:
    """Missed share per month number next to the mean of the monthly rates."""
    monthly = numbered.groupBy("month_num").agg(
        F.count("*").alias("total"),
        F.count_if(missed()).alias("no_show"),
        rate_pct(F.count_if(missed()), F.count("*")).alias("noshow_rate"),
    )
    # A mean of rounded rates: scale to whole hundredths so the sum is exact in any order.
    hundredths = F.sum(F.round(F.col("noshow_rate") * 100).cast("long"))
    period = monthly.agg(
        round_half_up(hundredths.cast("double") / F.count("*") / F.lit(100.0)).alias("period_avg_rate")
    )
    return with_scalars(monthly, period)


def satisfaction_trend(surveys: DataFrame) -> DataFrame:
    """K5: survey averages, recommendation share and complaints by survey month."""
    return _by_month(surveys, "survey_date").groupBy("month").agg(
        F.count("*").alias("surveys"),
        round_half_up(mean("overall_score")).alias("avg_overall"),
        round_half_up(mean("wait_time_rating")).alias("avg_wait_rating"),
        round_half_up(mean("doctor_rating")).alias("avg_doctor_rating"),
        rate_pct(F.sum("would_recommend"), F.count("*")).alias("recommend_rate_pct"),
        round_half_up(mean("nps_score")).alias("avg_nps"),
        F.count_if(is_complaint()).alias("complaints"),
    )


def satisfaction_by_visit_month(surveys: DataFrame, numbered: DataFrame) -> DataFrame:
    """Survey averages by the month number of the visit they belong to.

    Visits are reduced to one row per id first; surveys without a visit drop out.
    """
    visit_month = numbered.groupBy("appointment_id").agg(F.min("month_num").alias("month_num"))
    return (
        surveys.join(visit_month, "appointment_id")
        .groupBy("month_num")
        .agg(
            round_half_up(mean("overall_score")).alias("avg_score"),
            F.count("*").alias("n_surveys"),
            round_half_up(mean("nps_score")).alias("avg_nps"),
        )
    )


def satisfaction_monthly(surveys: DataFrame) -> DataFrame:
    """Average score and recommendation share by survey month."""
    return _by_month(surveys, "survey_date").groupBy("month").agg(
        round_half_up(mean("overall_score")).alias("avg_overall"),
        round_half_up(mean("would_recommend"), 4).alias("recommend_rate"),
    )


def revenue_per_visit(appointments: DataFrame) -> DataFrame:
    """K6: average billed, cost and margin of completed visits per specialty."""
    margin = F.col("billed_amount") - F.col("staff_cost")
    return appointments.groupBy("specialty").agg(
        F.count_if(done()).alias("completed"),
        round_half_up(mean_if(done(), "billed_amount")).alias("avg_billed"),
        round_half_up(mean_if(done(), "staff_cost")).alias("avg_cost"),
        round_half_up(mean_if(done(), margin)).alias("avg_margin"),
        rate_pct(mean_if(done(), margin), mean_if(done(), "billed_amount")).alias("margin_pct"),
    )


def churn_by_state_insurance(patients: DataFrame) -> DataFrame:
    """K7: churn share and lifetime value by state and insurance."""
    return patients.groupBy("state", "insurance_type").agg(
        F.count("*").alias("patients"),
        F.sum("churn_flag").alias("churned"),
        rate_pct(F.sum("churn_flag"), F.count("*")).alias("churn_rate_pct"),
        round_half_up(mean("total_billed")).alias("avg_lifetime_billed"),
    )


def churn_by_state(patients: DataFrame) -> DataFrame:
    """Churn share by state beside the overall rate."""
    overall = patients.agg(rate_pct(F.sum("churn_flag"), F.count("*")).alias("overall_churn_rate"))
    by_state = patients.groupBy("state").agg(
        F.count("*").alias("total_patients"),
        F.sum("churn_flag").alias("churned"),
        rate_pct(F.sum("churn_flag"), F.count("*"), 1).alias("churn_rate"),
        round_half_up(mean("total_billed")).alias("avg_billed"),
    )
    return with_scalars(by_state, overall)


def claim_rejections(claims: DataFrame) -> DataFrame:
    """K8: rejected claims by month and type; the value sums every row's rejected amount."""
    rejected = F.count_if(has_status("rejected", column="claim_status"))
    return _by_month(claims, "claim_date").groupBy("month", "claim_type").agg(
        F.count("*").alias("total_claims"),
        rejected.alias("rejected"),
        rate_pct(rejected, F.count("*")).alias("rejection_rate_pct"),
        money(F.coalesce(F.sum("rejected_amount"), F.lit(0))).alias("rejected_value"),
    )


def claim_refusals(claims: DataFrame) -> DataFrame:
    """Rejected or partly paid claims by month and type."""
    refused = F.count_if(normalised("claim_status").isin("rejected", "partial"))
    return _by_month(claims, "claim_date").groupBy("month", "claim_type").agg(
        F.count("*").alias("total_claims"),
        refused.alias("rejected_count"),
        rate_pct(refused, F.count("*")).alias("rejection_rate"),
    )


def claim_rejection_chart(claims: DataFrame) -> DataFrame:
    """Rejection share and value by month and type, rejected claims only in the value."""
    hit = has_status("rejected", column="claim_status")
    return _by_month(claims, "claim_date").groupBy("month", "claim_type").agg(
        rate_pct(F.count_if(hit), F.count("*")).alias("rejection_rate"),
        money(sum_if(hit, "rejected_amount")).alias("rejected_value"),
    )


def rejected_value_by_month(claims: DataFrame) -> DataFrame:
    """K8c, second series: rejected value by month."""
    rejected = claims.filter(has_status("rejected", column="claim_status"))
    return _by_month(rejected, "claim_date").groupBy("month").agg(
        money(F.sum("rejected_amount")).alias("rejected_value")
    )


def telehealth_trend(appointments: DataFrame) -> DataFrame:
    """K9: telehealth share and revenue of completed visits by month."""
    tele = F.col("appointment_type") == "telehealth"
    return _by_month(appointments.filter(done())).groupBy("month").agg(
        F.count("*").alias("total_appointments"),
        F.count_if(tele).alias("telehealth_count"),
        rate_pct(F.count_if(tele), F.count("*")).alias("telehealth_pct"),
        money(sum_if(tele, "billed_amount")).alias("telehealth_revenue"),
    )


def is_remote(column: str = "appointment_type") -> Column:
    return F.coalesce(normalised(column).rlike("|".join(REMOTE_WORDS)), F.lit(False))


def telehealth_by_keyword(appointments: DataFrame) -> DataFrame:
    """Remote share over all statuses, matched by keyword."""
    remote = F.col("remote")
    return (
        _by_month(appointments)
        .withColumn("remote", is_remote())
        .groupBy("month")
        .agg(
            F.count("*").alias("total"),
            F.count_if(remote).alias("telehealth"),
            money(sum_if(remote, "billed_amount")).alias("tele_rev"),
            money(sum_if(~remote, "billed_amount")).alias("inperson_rev"),
            rate_pct(F.count_if(remote), F.count("*")).alias("tele_rate"),
        )
    )


def telehealth_billing(appointments: DataFrame) -> DataFrame:
    """Average billed, remote against in person, completed visits."""
    return (
        appointments.filter(done())
        .groupBy(F.when(is_remote(), "Telehealth").otherwise("In-Person").alias("visit_kind"))
        .agg(round_half_up(mean("billed_amount")).alias("avg_billed"))
    )


def telehealth_growth(appointments: DataFrame, edge: int = 3) -> DataFrame:
    """K9d: growth from the first to the last ``edge`` monthly rates; 0 with too few months.

    The windows run over one row per month.
    """
    monthly = (
        _by_month(appointments)
        .groupBy("month")
        .agg(pct(F.count_if(is_remote()), F.count("*")).alias("rate"))
        .withColumn("up", F.row_number().over(Window.orderBy("month")))
        .withColumn("down", F.row_number().over(Window.orderBy(F.desc("month"))))
    )

    def edge_mean(rank: str) -> Column:
        # One value per position keeps the additions in month order.
        picks = [F.max(F.when(F.col(rank) == i, F.col("rate"))) for i in range(1, edge + 1)]
        return sum(picks[1:], picks[0]) / F.lit(float(edge))

    enough = F.col("n") >= 2 * edge
    return (
        monthly.agg(F.count("*").alias("n"), edge_mean("up").alias("early"), edge_mean("down").alias("late"))
        .select(
            F.col("n").alias("months"),
            F.when(enough, round_half_up(F.col("early"))).alias("early_rate"),
            F.when(enough, round_half_up(F.col("late"))).alias("late_rate"),
            F.when(
                enough, round_half_up((F.col("late") - F.col("early")) / (F.col("early") + F.lit(1e-9)) * 100)
            ).otherwise(F.lit(0.0)).alias("growth_pct"),
        )
    )


def out_of_pocket(appointments: DataFrame) -> DataFrame:
    """Gap payments and the uncollected remainder of completed visits by month."""
    gap = F.col("patient_gap")
    rest = (
        F.col("billed_amount") - F.col("medicare_rebate") - F.col("insurance_paid") - F.coalesce(gap, F.lit(0))
    )
    return _by_month(appointments.filter(done())).groupBy("month").agg(
        round_half_up(mean_if(gap > 0, gap)).alias("avg_gap_payment"),
        money(F.sum(gap)).alias("total_gap_collected"),
        money(F.sum(rest)).alias("uncollected"),
    )


CLINIC = ["clinic_name", "state", "clinic_type"]


def clinic_rollup(staff: DataFrame, appointments: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """Visit sums, visit-weighted rating and distinct patients per clinic, clinics without visits included.

    The sums are taken per staff member before the join, so a busy clinician is no hot key.  Distinct
    patients come from a pass of their own over two columns: folded into the first aggregate they
    would make Spark shuffle every visit with all its sums.
    """
    per_staff = appointments.groupBy("staff_id").agg(
        F.count("*").alias("visits"), *[c.alias(name) for name, c in sums.items()]
    )
    weight = F.greatest(F.coalesce(F.col("visits"), F.lit(0)), F.lit(1))
    # Ratings carry one decimal: whole tenths add up exactly.
    tenths = F.round(F.col("avg_patient_rating") * 10).cast("long")
    rating = F.sum(tenths * weight).cast("double") / F.sum(weight) / F.lit(10.0)
    table = staff.join(per_staff, "staff_id", "left").groupBy(*CLINIC).agg(
        F.coalesce(F.sum("visits"), F.lit(0)).alias("visits"),
        *[F.sum(name).alias(name) for name in sums],
        round_half_up(rating).alias("avg_staff_rating"),
    )
    pairs = appointments.select("staff_id", "patient_id").join(staff.select("staff_id", *CLINIC), "staff_id")
    people = pairs.select(*CLINIC, "patient_id").distinct().groupBy(*CLINIC).agg(F.count("patient_id").alias("people"))
    return table.join(people, CLINIC, "left").withColumn("people", F.coalesce("people", F.lit(0)))


def staff_utilisation(staff: DataFrame, appointments: DataFrame) -> DataFrame:
    """Completed visits, patients, revenue and rating per clinic."""
    rollup = clinic_rollup(staff, appointments.filter(done()), {"billed": F.sum("billed_amount")})
    return rollup.select(
        *CLINIC,
        F.col("visits").alias("total_appointments"),
        F.col("people").alias("unique_patients"),
        round_half_up(ratio(F.col("billed"), F.col("visits"))).alias("avg_billed_per_appt"),
        money(F.col("billed")).alias("total_revenue"),
        "avg_staff_rating",
    )


def referral_quality(patients: DataFrame) -> DataFrame:
    """Patient count, activity, value and churn per referral source."""
    return patients.groupBy("referral_source").agg(
        F.count_distinct("patient_id").alias("patients"),
        round_half_up(mean("total_appointments")).alias("avg_appointments"),
        round_half_up(mean("total_billed")).alias("avg_lifetime_value"),
        F.sum("churn_flag").alias("churned"),
        rate_pct(F.sum("churn_flag"), F.count("*")).alias("churn_rate_pct"),
    )


def extreme_row(df: DataFrame, name: str, by: str, *, largest: bool, prefix: str) -> DataFrame:
    """One row: the name with the largest or smallest value, ties to the smallest name."""
    key = F.struct((F.col(by) if not largest else -F.col(by)).alias("v"), F.col(name).alias("n"))
    kept = df.filter(F.col(by).isNotNull())
    return kept.agg(
        F.min_by(F.col(name), key).alias(prefix), F.min_by(F.col(by), key).alias(f"{prefix}_value")
    )


def executive_summary(appointments: DataFrame, patients: DataFrame, surveys: DataFrame) -> DataFrame:
    """Network totals plus the worst state, the longest wait and the best margin.

    Visits are read once into one row per specialty, which all their numbers come from.
    """
    per = appointments.groupBy("specialty").agg(
        F.count("*").alias("n"), F.count_if(done()).alias("done"), F.count_if(missed()).alias("missed"),
        F.count_if(is_bulk()).alias("bulk"), sum_if(done(), "billed_amount").alias("billed"),
        sum_if(done(), "staff_cost").alias("cost"), F.sum("wait_days").alias("wait"),
        F.count("wait_days").alias("waits"),
    )
    name = F.col("specialty")
    wait = round_half_up(ratio(F.col("wait"), F.col("waits")), 1)
    profit = ratio(F.col("billed"), F.col("done")) - ratio(F.col("cost"), F.col("done"))
    margin = rate_pct(profit, ratio(F.col("billed"), F.col("done")))

    def largest(value: Column, prefix: str) -> list[Column]:
        key = F.when(value.isNotNull(), F.struct((-value).alias("v"), name.alias("n")))
        return [F.min_by(name, key).alias(prefix), F.max(value).alias(f"{prefix}_value")]

    wide = per.agg(
        F.sum("n").alias("total_appointments"),
        F.sum("done").alias("completed_appointments"),
        money(F.sum("billed")).alias("total_revenue"),
        round_half_up(ratio(F.sum("billed"), F.sum("done"))).alias("avg_billed"),
        round_half_up(ratio(F.sum("wait"), F.sum("waits")), 1).alias("avg_wait_days"),
        rate_pct(F.sum("missed"), F.sum("n"), 1).alias("no_show_rate_pct"),
        rate_pct(F.sum("bulk"), F.sum("n"), 1).alias("bulk_billing_rate_pct"),
        *largest(wait, "longest_wait_specialty"),
        *largest(margin, "highest_margin_specialty"),
    )
    people = patients.agg(
        rate_pct(F.sum("churn_flag"), F.count("*"), 1).alias("churn_rate_pct"),
        F.count_if(F.col("medicare_number").contains("INVALID-")).alias("invalid_ids"),
    )
    opinion = surveys.agg(round_half_up(mean("overall_score")).alias("avg_satisfaction"))
    state = extreme_row(churn_by_state(patients), "state", "churn_rate", largest=True, prefix="highest_churn_state")
    for part in (people, opinion, state):
        wide = with_scalars(wide, part)
    return wide


def revenue_by_type(appointments: DataFrame, with_no_show: bool = True) -> DataFrame:
    """V1 and V6: month by billing type, optionally with the missed share."""
    out = _by_month(appointments).groupBy("month", "billing_type").agg(
        F.count_if(done()).alias("completed_appointments"),
        money(sum_if(done(), "billed_amount")).alias("total_revenue_aud"),
        round_half_up(mean_if(done(), "billed_amount")).alias("avg_billed_aud"),
        rate_pct(F.count_if(missed()), F.count("*")).alias("no_show_rate_pct"),
    )
    return out if with_no_show else out.drop("no_show_rate_pct")


def billing_leakage_view(claims: DataFrame) -> DataFrame:
    """V3: rejected claims by month and type, rejected rows only in the value."""
    hit = has_status("rejected", column="claim_status")
    return _by_month(claims, "claim_date").groupBy("month", "claim_type").agg(
        F.count("*").alias("total_claims"),
        F.count_if(hit).alias("rejected_claims"),
        money(sum_if(hit, "rejected_amount")).alias("rejected_value_aud"),
        rate_pct(F.count_if(hit), F.count("*")).alias("rejection_rate_pct"),
    )
