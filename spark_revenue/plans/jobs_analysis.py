"""Root cause, churn rules, scorecards, windows, joins and leakage (ids A, V, P, W, J, G, D, X, L)."""

from ..functions.exprs import month_number
from ..operators import churn_rules as c
from ..operators import joins as j
from ..operators import kpis as k
from ..operators import leakage as l
from ..operators import rootcause as r
from ..operators import scorecards as s
from ..operators import windows as w
from ..sources.binding import DomainTables
from .registry import job

_BILLS = ("appointment_date", "status", "billing_type", "billed_amount")
REPORT_MONTH = "1997-07-15"


def _dates(t: DomainTables):
    """Visit dates alone: first and last days come from here, without the joins of wider frames."""
    return t.appointments("appointment_date")


def _numbered(t: DomainTables):
    return month_number(t.appointments(*_BILLS, "wait_days"), dates=_dates(t))


def _people(t: DomainTables):
    return t.patients("patient_id", "insurance_type", "state", "chronic_conditions", "churn_flag", "total_billed")


def _recency(t: DomainTables):
    return t.appointments("appointment_id", "patient_id", "appointment_date", "status", "wait_days")


def _leak(fn):
    return lambda t: fn(t.appointments(*_BILLS, "scheduled_fee"), t.claims())


def _pair(t: DomainTables):
    return t.appointments("appointment_date", "specialty", "status", "billed_amount")


job("a01_monthly_growth", lambda t: r.monthly_growth(t.appointments(*_BILLS)))
job("a02_month_pair_effects", lambda t: r.month_pair_effects(_pair(t), dates=_dates(t)))
job("a02b_named_month_pair", lambda t: r.month_pair_effects(_pair(t), later="1998-07-01", dates=_dates(t)))
job("a03_churn_features", lambda t: c.churn_features(
    _people(t), t.appointments("appointment_id", "patient_id", "appointment_date", "status", "billed_amount",
                               "wait_days", "appointment_type"), t.surveys(), _dates(t)))
job("a04_churn_rule_scores", lambda t: c.churn_rule_scores(_people(t), _recency(t), t.surveys(), _dates(t)))
job("a04b_churn_rule_scores_fanout", lambda t: c.churn_rule_scores(
    _people(t), _recency(t), t.surveys(), _dates(t), fanout=True))
job("a05_priority_retention", lambda t: c.priority_retention(_people(t), _recency(t), t.surveys(), _dates(t)))
job("a06_medicare_rejections", lambda t: l.medicare_rejections(t.claims()))
job("a07_no_show_loss", lambda t: l.no_show_loss(
    t.appointments("appointment_date", "specialty", "status", "scheduled_fee")))
job("a08_bulk_erosion_by_month", lambda t: r.erosion_by_month(t.appointments(*_BILLS)))
_CARD = ("appointment_id", "specialty", "status", "billed_amount", "staff_cost", "wait_days", "billing_type")
job("a09_specialty_scorecard", lambda t: s.specialty_scorecard(
    t.appointments(*_CARD), t.surveys("appointment_id", "overall_score")))
job("a10_clinic_ranking", lambda t: s.clinic_ranking(
    t.staff(), t.appointments("staff_id", "patient_id", "status", "billed_amount")))
job("a11_telehealth_comparison", lambda t: s.telehealth_comparison(
    t.appointments("appointment_id", "appointment_date", "appointment_type", "status", "billed_amount", "wait_days"),
    t.surveys("appointment_id", "overall_score")))
job("a12_month_comparison", lambda t: r.month_comparison(_numbered(t), 30, 31))
job("a13_revenue_bridge", lambda t: r.revenue_bridge(_numbered(t), 30, 31))

job("v02_churn_risk", lambda t: c.churn_risk_view(_people(t), _recency(t), t.surveys(), _dates(t)))
job("v04_specialty_scorecard", lambda t: s.specialty_scorecard_view(
    t.appointments(*_CARD[:-1]), t.surveys("appointment_id", "overall_score")))
job("v05_clinic_performance", lambda t: s.clinic_ranking(
    t.staff(), t.appointments("staff_id", "patient_id", "status", "billed_amount"), with_avg=False))
job("v07_retention_priority", lambda t: c.retention_priority_view(_people(t), _recency(t), _dates(t)))
job("p02_flag_high_churn", lambda t: c.flag_high_churn(c.churn_risk_view(_people(t), _recency(t), t.surveys(), _dates(t))))
job("p03_leakage_report", lambda t: l.leakage_report(t.claims(), REPORT_MONTH).drop("rejection_rate_pct"))
job("p04_leakage_report_rate", lambda t: l.leakage_report(t.claims(), REPORT_MONTH))
job("p05_churn_alert", lambda t: c.churn_alert(c.retention_priority_view(_people(t), _recency(t), _dates(t))))

job("w01_revenue_growth", lambda t: w.revenue_growth(t.appointments(*_BILLS)))
job("w02_patient_rank_pareto", lambda t: w.patient_rank_and_pareto(t.patients()))
job("w03_rolling_bulk_rate", lambda t: w.rolling_bulk_rate(t.appointments(*_BILLS)))
job("w04_no_show_against_average", lambda t: w.no_show_against_average(t.appointments("specialty", "status")))
_VISIT = ("appointment_id", "patient_id", "appointment_date", "specialty", "billing_type", "status", "billed_amount")
job("w05_patient_journey", lambda t: w.patient_journey(t.appointments(*_VISIT)))
job("w06_neighbour_months", lambda t: w.neighbour_months(t.appointments(*_BILLS)))
job("w07_patient_ranks", lambda t: w.patient_ranks(t.patients("patient_id", "state", "total_billed")))
job("w08_patient_pareto", lambda t: w.patient_pareto(t.patients("patient_id", "total_billed")))
job("w09_running_and_rolling", lambda t: w.running_and_rolling(t.appointments(*_BILLS)))
job("w10_patient_journey_short", lambda t: w.patient_journey(t.appointments(*_VISIT), with_billed=False))

job("j01_surveyed_visits", lambda t: j.surveyed_visits(
    t.appointments("appointment_id", "specialty", "wait_days", "billing_type", "status"), t.surveys()))
job("j02_never_surveyed", lambda t: j.never_seen(_people(t), t.surveys("patient_id")))
job("j03_month_pair", lambda t: r.month_pair_effects(_pair(t), dates=_dates(t)).select(
    "specialty", "m6_revenue", "m7_revenue", "revenue_delta", "volume_effect", "rate_effect"))
job("g01_above_network_no_show", lambda t: s.above_network_no_show(t.appointments("specialty", "status")))
job("g02_above_average_value", lambda t: j.above_average_value(_people(t)))
job("g03_claims_by_type", lambda t: l.claims_by_type(t.claims()))
job("d01_age_bands", lambda t: j.age_bands(
    t.patients("patient_id", "date_of_birth"),
    t.appointments("patient_id", "appointment_date", "status", "billing_type", "billed_amount"),
    _dates(t)))
job("d02_inactive_patients", lambda t: c.inactive_patients(_people(t), _recency(t), _dates(t)))
job("x01_valuable_inactive", lambda t: c.valuable_inactive(_people(t), _recency(t), t.surveys(), _dates(t)))

job("l00_baselines", _leak(l.baselines))
job("l01_bucket_counts", _leak(l.bucket_counts))
job("l05_bulk_erosion", _leak(l.bulk_erosion))
job("l06_leakage_summary", _leak(l.leakage_summary))
job("l07_leakage_bridge", _leak(l.leakage_bridge))
job("l08_monthly_leakage", _leak(l.monthly_leakage))
job("l09_recovery_rows", _leak(l.recovery_rows))
job("l09b_recovery_scenarios", _leak(l.recovery_scenarios))
job("l09c_recovery_totals", _leak(l.recovery_totals))
job("l10_leakage_headline", _leak(l.leakage_headline))


def _card_visits(t: DomainTables):
    """The visits all views read."""
    return t.appointments(*_CARD, "patient_id", "staff_id", "appointment_date")


def _views(t: DomainTables, visits, staff) -> dict:
    surveys = t.surveys()
    return {
        "vw_monthly_revenue": k.revenue_by_type(visits),
        "vw_churn_risk": c.churn_risk_view(_people(t), visits, surveys, _dates(t)),
        "vw_billing_leakage": k.billing_leakage_view(t.claims()),
        "vw_specialty_scorecard": s.specialty_scorecard_view(visits, surveys),
        "vw_clinic_performance": s.clinic_ranking(staff, visits, with_avg=False),
    }

