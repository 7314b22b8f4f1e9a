"""Profitability, segments, features, model, recommendations and dashboard (ids T, R, F, E, B)."""

from pyspark.sql import DataFrame, functions as F

from ..operators import churn_rules as c
from ..operators import dashboard as b
from ..operators import explain as x
from ..operators import features as f
from ..operators import kpis as k
from ..operators import leakage as l
from ..operators import linear as lin
from ..operators import model as m
from ..operators import profitability as p
from ..operators import recommend as e
from ..operators import segmentation as g
from ..operators import validation as v
from ..operators.model_store import ModelStore, data_version
from ..session import stored
from ..sources.binding import DomainTables
from .registry import job

# A linear model (feature, mean, deviation, coefficient) and its log-odds at the means.
FIXED_BASE = -0.75
FIXED_COEFFICIENTS = [
    ("appointment_count", 15.0, 10.0, -0.4), ("total_billed", 150000.0, 100000.0, -0.1), ("avg_billed", 20000.0, 8000.0, 0.05),
    ("avg_wait_days", 10.0, 8.0, 0.2), ("no_show_rate", 0.1, 0.1, 0.5), ("telehealth_rate", 0.2, 0.25, -0.1),
    ("days_since_visit", 300.0, 250.0, 0.8), ("avg_overall_score", 4.0, 1.0, -0.3), ("avg_wait_rating", 3.0, 1.0, -0.05),
    ("complaint_count", 1.0, 1.0, 0.25), ("never_varies", 1.0, 0.0, 9.0), ("state_ASIA", 0.25, 0.5, 0.15),
    ("state_EUROPE", 0.25, 0.5, -0.2), ("insurance_type_BUILDING", 0.2, 0.4, 0.3), ("insurance_type_MACHINERY", 0.2, 0.4, -0.25),
    ("chronic_conditions_Diabetes", 0.125, 0.5, 0.35), ("chronic_conditions_None", 0.5, 0.5, -0.15),
]

_PL = ("specialty", "staff_id", "status", "billing_type", "billed_amount", "staff_cost", "wait_days")
_RFV = ("patient_id", "appointment_id", "appointment_date", "status", "billed_amount", "wait_days")
_FEAT = (*_RFV, "appointment_type")
_BILLS = ("appointment_date", "status", "billing_type", "billed_amount")
_SCORE = ("appointment_id", "overall_score")


def _dates(t: DomainTables) -> DataFrame:
    """Visit dates alone, for the last day in the data."""
    return t.appointments("appointment_date")


# --- T ----------------------------------------------------------------------------------------
def _profit(t: DomainTables) -> DataFrame:
    return p.specialty_profit(t.appointments(*_PL), t.staff())


def _clinics(t: DomainTables) -> DataFrame:
    return p.clinic_performance(
        t.appointments("appointment_id", "staff_id", "status", "billed_amount", "wait_days"), t.staff(),
        t.surveys(*_SCORE))


job("t00_completed_with_clinic", lambda t: p.completed_with_clinic(
    t.appointments("appointment_id", "staff_id", "specialty", "status", "billed_amount", "staff_cost"), t.staff()
).withColumn("margin_pct", p.round_half_up(F.col("margin_pct"), 4)))
job("t01_specialty_pl", _profit)
job("t02_margin_bands", lambda t: p.margin_bands(_profit(t)))
job("t03_wait_satisfaction", lambda t: p.wait_against_satisfaction(
    t.appointments("appointment_id", "specialty", "status", "wait_days"), t.surveys(*_SCORE)))
job("t04_clinic_performance", _clinics)
job("t04b_clinic_wait_proxy", lambda t: p.wait_proxy(_clinics(t)))
job("t05_best_and_worst", lambda t: p.best_and_worst(_profit(t)))
job("t06_margin_chart", lambda t: p.margin_chart(t.appointments("specialty", "status", "billed_amount", "staff_cost")))


# --- R ----------------------------------------------------------------------------------------
def _rfv(t: DomainTables) -> DataFrame:
    return g.rfv(t.appointments(*_RFV), _dates(t))


def _scored(t: DomainTables) -> DataFrame:
    return g.quartile_scores(_rfv(t))


def _segments(t: DomainTables) -> DataFrame:
    return g.segments(_scored(t), t.patients())


def rule_probability(t: DomainTables) -> DataFrame:
    """A score between 0 and 1 both engines can compute: 20 points per rule point, half the missed share."""
    people = t.patients("patient_id", "churn_flag", "insurance_type", "total_billed")
    visits = t.appointments("patient_id", "appointment_id", "appointment_date", "status")
    scores = c.churn_rule_scores(people, visits, t.surveys(), _dates(t), with_no_show=True)
    points = F.col("churn_risk_score") * 20.0 + F.coalesce("no_show_rate_pct", F.lit(0.0)) / 2.0
    return scores.select(
        "patient_id", "churn_flag", F.col("lifetime_billed").alias("total_billed"),
        p.round_half_up(F.least(F.lit(1.0), points / 100.0), 4).alias("churn_probability"),
    )


job("r01_rfv", lambda t: _rfv(t).withColumn("avg_wait_days", p.round_half_up(F.col("avg_wait_days"), 6)))
job("r01b_describe", lambda t: g.describe_rfv(_rfv(t)))
job("r02_quartile_scores", lambda t: _scored(t).select("patient_id", "R", "F", "V", "RFV_avg"))
job("r03_score_distribution", lambda t: g.score_distribution(_scored(t)))
job("r04_segments", _segments)
job("r05_segment_profile", lambda t: g.segment_profile(_segments(t), t.surveys()).drop("avg_churn_prob"))
job("r06_segment_churn", lambda t: g.segment_profile(_segments(t), t.surveys(), rule_probability(t)))
job("r07_export", lambda t: g.export_segments(_segments(t), t.surveys(), rule_probability(t)).select(
    "patient_id", "segment", "churn_probability", "avg_satisfaction"))
job("r07b_segment_summary", lambda t: g.segment_summary(_segments(t)))
job("r08_playbook", lambda t: g.playbook(_segments(t)))
job("r09_segment_sizes", lambda t: g.segment_sizes(_segments(t)))


# --- F ----------------------------------------------------------------------------------------
def _features(t: DomainTables) -> DataFrame:
    return f.build_features(t.patients(), t.appointments(*_FEAT), t.surveys(), _dates(t))


def _matrix(t: DomainTables) -> DataFrame:
    return f.coded_matrix(_features(t))


def _kept_matrix(t: DomainTables) -> DataFrame:
    """The matrix as a table, for queries that read it more than once."""
    return stored(_matrix(t))


def _trained(t: DomainTables, kind: str, trees: int = 150, kept: DataFrame | None = None) -> m.TrainedModel:
    """The stored model of this state of the data; the training step comes first where there is none.

    It reads the ``kept`` matrix where the query has one.
    """
    store, version = ModelStore(t.spark), f"{trees}-{data_version(t.spark, t.path)}"
    store.ensure(kind, version, lambda: m.train_model(
        _matrix(t) if kept is None else kept, kind, trees=trees, kept=kept is not None))
    return store.load(kind, version)


def _fixed_model(t: DomainTables) -> DataFrame:
    """A table of coefficients that both engines can be given."""
    return t.spark.createDataFrame(
        [(*row, FIXED_BASE) for row in FIXED_COEFFICIENTS], "feature string, mean double, std double, coefficient double, base double"
    )


def _fixed_scores(t: DomainTables, matrix: DataFrame) -> DataFrame:
    scores = lin.linear_scores(matrix, _fixed_model(t))
    return scores.withColumn("churn_probability", p.round_half_up(F.col("churn_probability"), 4))


def _banded(t: DomainTables) -> DataFrame:
    return m.band_scores(rule_probability(t))


def _metrics(t: DomainTables, kind: str) -> DataFrame:
    return m.metrics(_trained(t, kind).test)


def _cv(t: DomainTables, kind: str) -> DataFrame:
    return v.cross_validation_summary(v.cross_validate(_matrix(t), kind))


def _folds(t: DomainTables) -> DataFrame:
    return v.stratified_folds(t.patients("patient_id", "churn_flag"))


def _codes(t: DomainTables) -> DataFrame:
    people = f.coded_matrix(t.patients("patient_id", "insurance_type", "state", "chronic_conditions"))
    return f.encode(people, f.fit_dictionary(people)).withColumns(
        {c: F.array_join(F.col(c).cast("array<string>"), ",") for c in ("indices", "values")})


job("f01_churn_features", _features)
job("f01b_churn_features_wide", lambda t: f.build_features_wide(
    t.patients(), t.appointments(*_FEAT), t.surveys(), _dates(t)))
job("f02_one_hot", lambda t: f.one_hot(
    t.patients("patient_id", "insurance_type", "state"), {"insurance_type": "ins", "state": "state"}))
job("f02c_sparse_codes", _codes)
job("f02d_dictionary", lambda t: f.fit_dictionary(f.coded_matrix(
    t.patients("patient_id", "insurance_type", "state", "chronic_conditions"))))
job("f02b_one_hot_drop_first", lambda t: f.one_hot(
    t.patients("patient_id", "insurance_type", "state"), {"insurance_type": "ins", "state": "state"}, drop_first=True))
job("f03_condition_flags", lambda t: f.condition_flags(t.patients("patient_id", "chronic_conditions")))
job("f04_stratified_split", lambda t: m.stratified_split(t.patients("patient_id", "churn_flag")))
job("f04b_exact_split_sizes", lambda t: m.stratified_split(
    t.patients("patient_id", "churn_flag"), exact=True).groupBy("churn_flag", "is_test").agg(F.count("*").alias("n")))
job("f05a_logistic_metrics", lambda t: _metrics(t, "logistic"))
job("f05b_boosting_metrics", lambda t: _metrics(t, "gbt"))
job("f05c_ranking_quality", lambda t: m.ranking_quality(rule_probability(t)))
job("f05d_roc_points", lambda t: m.roc_points(rule_probability(t)))
job("f05e_confusion", lambda t: m.confusion(rule_probability(t)))
job("f05f_cross_validation", lambda t: _cv(t, "logistic"))
job("f05g_folds", _folds)
job("f05h_classification_report", lambda t: v.classification_report(
    rule_probability(t).withColumn("predicted", (F.col("churn_probability") >= 0.5).cast("int")), "churn_flag"))
job("f05i_cross_validation_boosting", lambda t: _cv(t, "gbt"))
job("f05j_fold_sizes", lambda t: v.fold_sizes(_folds(t)))
job("f05k_band_report", lambda t: v.classification_report(
    m.band_scores(rule_probability(t)).withColumn("label", F.when(F.col("churn_flag") == 1, "High").when(
        F.col("total_billed") > 0, "Medium").otherwise("Low")), "label", "risk_band"))


def _on_matrix(use):
    """A query of the logistic model and the matrix, which training and ``use`` read from one table."""
    def build(t: DomainTables) -> DataFrame:
        matrix = _kept_matrix(t)
        return use(_trained(t, "logistic", kept=matrix), matrix)

    return build


job("f06_score_patients", _on_matrix(m.score_patients))
job("f06c_linear_scores", lambda t: _fixed_scores(t, _kept_matrix(t)))
job("f06b_risk_bands", _banded)
job("f07_revenue_at_risk", lambda t: m.revenue_at_risk(_banded(t)))
job("f07b_risk_summary", lambda t: m.risk_summary(_banded(t)))
job("f07c_risk_totals", lambda t: m.risk_totals(_banded(t)))
job("f08_retention_list", lambda t: m.retention_list(_banded(t), t.patients()))
job("f09_importance_boosting", lambda t: x.feature_importance(t.spark, _trained(t, "gbt")))
job("f09b_importance_logistic", lambda t: x.feature_importance(t.spark, _trained(t, "logistic")))
job("f10_mean_attribution", _on_matrix(x.mean_attribution))
job("f10b_linear_attribution", lambda t: lin.mean_attributions(_kept_matrix(t), _fixed_model(t)))
job("f11_explain_top_patient", _on_matrix(
    lambda trained, matrix: x.explain_patient(trained, matrix, m.score_patients(trained, matrix))))


def _linear_explanation(t: DomainTables) -> DataFrame:
    matrix = _kept_matrix(t)
    return lin.explain_row(matrix, _fixed_model(t), _fixed_scores(t, matrix))


job("f11b_linear_explanation", _linear_explanation)
job("f12_band_distribution", lambda t: m.band_distribution(_banded(t)))


# --- E ----------------------------------------------------------------------------------------
_WAITS = ("specialty", "status", "wait_days")


def _billing(t: DomainTables) -> DataFrame:
    return t.appointments("specialty", "billing_type", "appointment_date", "scheduled_fee")


def _leakage(t: DomainTables) -> DataFrame:
    return l.leakage_summary(t.appointments(*_BILLS, "scheduled_fee"), t.claims())


def _recs(t: DomainTables) -> DataFrame:
    return e.recommendations(
        rule_probability(t), t.appointments(*_WAITS), _billing(t), _leakage(t),
        dates=_dates(t), fees=t.appointments("scheduled_fee"))


def _alone(df: DataFrame) -> DataFrame:
    return df.select(*[col for col in df.columns if not col.startswith("__")])


job("e01_churn_prevention", lambda t: _alone(e.churn_prevention(rule_probability(t))))
job("e02_bulk_billing", lambda t: _alone(e.bulk_billing_optimisation(_billing(t), _dates(t))))
job("e02b_bulk_billing_no_date", lambda t: _alone(e.bulk_billing_drop(t.appointments("specialty", "billing_type"))))
job("e03_wait_sla", lambda t: _alone(e.wait_sla_breaches(t.appointments(*_WAITS))))
job("e04_no_show_reduction", lambda t: _alone(e.no_show_reduction(t.appointments(*_WAITS), t.appointments("scheduled_fee"))))
job("e05_claim_recovery", lambda t: _alone(e.claim_recovery(_leakage(t))))
# Clinical specialties for the driver's part types, and fewer bulk-billed visits of two of them in the last month.
CLINICAL = ["GP", "Mental Health", "Cardiology", "Dental"]


def _clinical(t: DomainTables, *columns: str) -> DataFrame:
    visits = t.appointments("staff_id", "appointment_id", "appointment_date", "billing_type", *columns)
    named = F.element_at(F.array(*[F.lit(x) for x in CLINICAL]), (F.col("staff_id") % len(CLINICAL) + 1).cast("int"))
    dropped = (F.col("staff_id") % 4 == 0) | ((F.col("staff_id") % 4 == 2) & (F.col("appointment_id") % 3 == 0))
    late = F.col("appointment_date") >= F.add_months("__last", -1)
    kept = F.when(late & dropped, F.lit("private")).otherwise(F.col("billing_type"))
    last = _dates(t).agg(F.max("appointment_date").alias("__last"))
    return p.with_scalars(visits, last).withColumns({"specialty": named, "billing_type": kept}).drop("__last")


job("e02d_bulk_billing_drop", lambda t: _alone(e.bulk_billing_optimisation(
    _clinical(t).select("specialty", "billing_type", "appointment_date"), _dates(t))))
job("e03b_wait_sla_levels", lambda t: _alone(e.wait_sla_breaches(_clinical(t, "wait_days"))))
job("e08_column_discovery", lambda t: e.discover_columns(e.described({
    "patients": t.patients(), "staff": t.staff(), "appointments": t.appointments(), "satisfaction_surveys": t.surveys(),
    "billing_claims": t.claims()})))
job("e06_recommendations", _recs)
job("e07_totals", lambda t: e.totals(_recs(t)))

# --- B ----------------------------------------------------------------------------------------
job("b00_filter_slice", lambda t: b.filter_slice(
    t.appointments("appointment_id", "specialty", "clinic_id", "appointment_type", "appointment_date", "wait_days"),
    specialty="ECONOMY", kind="telehealth", start="1997-01-01", end="1998-12-31"))
job("b01_kpi_cards", lambda t: b.kpi_cards(
    t.appointments("appointment_id", "status", "billing_type", "billed_amount", "wait_days"), t.patients("churn_flag")))
job("b02_revenue_trend", lambda t: b.revenue_trend(t.appointments(*_BILLS)))
job("b03_wait_chart", lambda t: k.wait_bands(t.appointments(*_WAITS)))
job("b04_satisfaction_chart", lambda t: b.satisfaction_chart(t.surveys()))
job("b05_margin_chart", lambda t: p.margin_chart(t.appointments("specialty", "status", "billed_amount", "staff_cost")))
job("b06_churn_chart", lambda t: b.churn_chart(t.patients("state", "churn_flag", "total_billed")))
job("b07_segment_treemap", lambda t: g.segment_sizes(_segments(t)))
job("b08_claims_chart", lambda t: k.claim_rejection_chart(t.claims()))
job("b09_filter_options", lambda t: b.filter_options(
    t.appointments("specialty", "clinic_id", "appointment_type", "appointment_date")))
