"""KPI queries (ids K and V1, V3, V6)."""

from ..functions.exprs import month_number
from ..operators import kpis as k
from .registry import job

job("k01_monthly_revenue", lambda t: k.monthly_revenue(
    t.appointments("appointment_date", "status", "billing_type", "billed_amount")))
job("k01b_revenue_pivot", lambda t: k.revenue_pivot(
    t.appointments("appointment_date", "status", "billing_type", "billed_amount")))
job("k01c_revenue_share", lambda t: k.revenue_share(
    t.appointments("appointment_date", "status", "billing_type", "billed_amount")))
job("k02_bulk_billing_rate", lambda t: k.bulk_billing_rate(
    t.appointments("appointment_date", "status", "billing_type")))
job("k02b_bulk_rate_all_visits", lambda t: k.bulk_billing_rate(
    t.appointments("appointment_date", "status", "billing_type"), denominator="all"))
job("k03_wait_by_specialty", lambda t: k.wait_by_specialty(
    t.appointments("specialty", "wait_days", "status")))
job("k03b_wait_all_statuses", lambda t: k.wait_all_statuses(
    t.appointments("specialty", "wait_days", "status")))
job("k03c_wait_bands", lambda t: k.wait_bands(t.appointments("specialty", "wait_days", "status")))
job("k04_no_show_by_specialty", lambda t: k.no_show_by_specialty(
    t.appointments("appointment_date", "specialty", "status", "scheduled_fee")))
job("k04b_no_show_trend", lambda t: k.no_show_trend(
    month_number(t.appointments("appointment_date", "status"))))
job("k05_satisfaction_trend", lambda t: k.satisfaction_trend(t.surveys()))
job("k05b_satisfaction_by_visit_month", lambda t: k.satisfaction_by_visit_month(
    t.surveys("appointment_id", "overall_score", "nps_score"),
    month_number(t.appointments("appointment_id", "appointment_date"))))
job("k05c_satisfaction_monthly", lambda t: k.satisfaction_monthly(t.surveys()))
job("k06_revenue_per_visit", lambda t: k.revenue_per_visit(
    t.appointments("specialty", "status", "billed_amount", "staff_cost")))
job("k07_churn_by_state_insurance", lambda t: k.churn_by_state_insurance(t.patients()))
job("k07b_churn_by_state", lambda t: k.churn_by_state(t.patients("state", "churn_flag", "total_billed")))
job("k08_claim_rejections", lambda t: k.claim_rejections(t.claims()))
job("k08b_claim_refusals", lambda t: k.claim_refusals(t.claims()))
job("k08c_claim_rejection_chart", lambda t: k.claim_rejection_chart(t.claims()))
job("k08d_rejected_value_by_month", lambda t: k.rejected_value_by_month(t.claims()))
job("k09_telehealth_trend", lambda t: k.telehealth_trend(
    t.appointments("appointment_date", "appointment_type", "status", "billed_amount")))
job("k09b_telehealth_by_keyword", lambda t: k.telehealth_by_keyword(
    t.appointments("appointment_date", "appointment_type", "billed_amount")))
job("k09c_telehealth_billing", lambda t: k.telehealth_billing(
    t.appointments("appointment_type", "status", "billed_amount")))
job("k09d_telehealth_growth", lambda t: k.telehealth_growth(
    t.appointments("appointment_date", "appointment_type")))
job("k10_out_of_pocket", lambda t: k.out_of_pocket(t.appointments(
    "appointment_date", "status", "billed_amount", "medicare_rebate", "insurance_paid", "patient_gap")))
job("k11_staff_utilisation", lambda t: k.staff_utilisation(
    t.staff(), t.appointments("staff_id", "patient_id", "status", "billed_amount")))
job("k12_referral_quality", lambda t: k.referral_quality(t.patients()))
job("k13_executive_summary", lambda t: k.executive_summary(
    t.appointments("specialty", "status", "billing_type", "billed_amount", "staff_cost", "wait_days"),
    t.patients("state", "churn_flag", "total_billed", "medicare_number"), t.surveys("overall_score")))
job("k14_month_number", lambda t: month_number(
    t.appointments("appointment_date").groupBy("appointment_date").count()))
job("v01_monthly_revenue", lambda t: k.revenue_by_type(
    t.appointments("appointment_date", "billing_type", "status", "billed_amount")))
job("v03_billing_leakage", lambda t: k.billing_leakage_view(t.claims()))
job("v06_monthly_revenue_by_type", lambda t: k.revenue_by_type(
    t.appointments("appointment_date", "billing_type", "status", "billed_amount"), with_no_show=False))
