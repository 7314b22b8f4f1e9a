"""Data-quality queries (ids C and S9), on the dirty binding."""

from pyspark.sql import functions as F

from ..operators import quality as q
from ..sources.binding import DomainTables
from .registry import job

DRIVER_TYPES = {"economy": "Economy Class", "standard": "Standard Class"}
_APPT_NULLS = ["patient_gap", "billed_amount", "medicare_rebate", "appointment_date", "wait_days", "status"]
_REPORTED = ["appointment_id", "patient_id", "specialty", "appointment_date", "patient_gap", "billed_amount",
             "medicare_rebate", "insurance_paid"]


def raw_tables(t: DomainTables) -> dict:
    return {**t.all(), "appointments": t.appointments_raw()}


def _reported(t: DomainTables) -> tuple[dict, dict]:
    """Raw and clean tables with only the columns the before-and-after reports read."""
    raw = {
        "patients": t.patients("patient_id", "medicare_number"),
        "staff": t.staff(),
        "appointments": t.appointments_raw(*_REPORTED),
        "satisfaction_surveys": t.surveys(),
        "billing_claims": t.claims(),
    }
    return raw, q.clean_all(raw)


job("c01_null_audit", lambda t: q.null_audit(t.appointments(), _APPT_NULLS, "total_appointments"))
job("c01b_survey_null_audit", lambda t: q.survey_null_audit(t.surveys()))
job("c01c_null_summary", lambda t: q.null_summary(
    {"patients": t.patients(), "appointments": t.appointments(), "surveys": t.surveys(), "claims": t.claims()}))
job("c02_duplicate_keys", lambda t: q.duplicate_keys(t.appointments("appointment_id"), ["appointment_id"]))
job("c02b_full_duplicates", lambda t: q.duplicate_report(t.appointments_raw()))
job("c03_specialty_spellings", lambda t: q.value_counts(t.appointments_raw("specialty"), "specialty"))
job("c04_impossible_dates", lambda t: q.impossible_survey_dates(t.order_surveys(), t.order_appointments()))
job("c04b_impossible_date_count", lambda t: q.impossible_survey_count(t.order_surveys(), t.order_appointments()))
job("c05_identifier_digits", lambda t: q.invalid_identifiers(t.patients("patient_id", "medicare_number")))
job("c05b_identifier_mark", lambda t: q.invalid_identifiers(t.patients("patient_id", "medicare_number"), "mark"))
job("c06_negative_money", lambda t: q.negative_amounts(
    t.appointments(), ["billed_amount", "medicare_rebate", "patient_gap", "insurance_paid"], ["appointment_id"]))
job("c06b_negative_balances", lambda t: q.negative_amounts(t.patients(), ["total_billed"], ["patient_id"]))
job("c07_fill_gap", lambda t: q.fill_gap(t.appointments("appointment_id", "patient_gap")))
job("c08_first_per_key", lambda t: q.first_per_key(
    t.appointments("appointment_id", "appointment_date", "wait_days", "scheduled_fee", "patient_gap"),
    ["appointment_id"]))
job("c08b_drop_full_duplicates", lambda t: q.drop_full_duplicates(t.appointments_raw(
    "appointment_id", "patient_id", "specialty", "appointment_date", "scheduled_fee")))
job("c09_canonical_keep", lambda t: q.value_counts(q.canonicalise(
    t.appointments_raw("specialty"), mapping=q.SPECIALTY_MAP_WIDE, unmatched="keep"), "specialty"))
job("c09b_canonical_title", lambda t: q.value_counts(q.canonicalise(t.appointments_raw("specialty")), "specialty"))
job("c09c_canonical_mapped", lambda t: q.value_counts(q.canonicalise(
    t.appointments_raw("specialty"), mapping=DRIVER_TYPES), "specialty"))
job("c10_parse_dates", lambda t: t.appointments_raw("appointment_id", "appointment_date").select(
    "appointment_id", q.parse_date("appointment_date").alias("appointment_date")))
job("c10b_unparsed_dates", lambda t: q.unparsed_dates(t.appointments_raw("appointment_date"), "appointment_date"))
job("c11_repair_dates_3", lambda t: q.repair_survey_dates(t.order_surveys(), t.order_appointments(), days=3))
job("c11b_repair_dates_1", lambda t: q.repair_survey_dates(t.order_surveys(), t.order_appointments()))
job("c11c_recount_after_repair", lambda t: q.impossible_survey_count(
    q.repair_survey_dates(t.order_surveys(), t.order_appointments()), t.order_appointments()))
job("c12_fill_medians", lambda t: q.fill_medians(
    t.surveys("survey_id", "overall_score", "wait_time_rating", "doctor_rating"),
    ["overall_score", "wait_time_rating", "doctor_rating"]))
job("c12b_fill_score_median", lambda t: q.fill_medians(t.surveys("survey_id", "overall_score"), ["overall_score"]))
job("c13_flag_identifiers", lambda t: q.flag_identifiers(t.patients("patient_id", "medicare_number")))
job("c14_impossible_ages", lambda t: q.impossible_ages(t.patients("age")))
job("c15_validation_scorecard", lambda t: q.validation_scorecard(
    t.patients(), t.appointments("appointment_id", "appointment_date", "patient_gap", "billed_amount"), t.surveys()))
job("c16_shape_comparison", lambda t: q.shape_comparison(*_reported(t)))
job("c17_fix_summary", lambda t: q.fix_summary(*_reported(t)))
job("c18_tracked_nulls", lambda t: q.tracked_nulls(*_reported(t)))
job("c19_amount_from_text", lambda t: t.appointments("appointment_id", "scheduled_fee").select(
    "appointment_id",
    F.when(F.col("appointment_id") % 1001 == 1, "n/a").otherwise(F.col("scheduled_fee").cast("string")).alias("fee"),
).withColumn("fee", q.to_amount("fee")))
job("c20_clean_appointments", lambda t: q.clean_all(raw_tables(t))["appointments"])
job("c20b_clean_surveys", lambda t: q.clean_all({
    "patients": t.patients(), "staff": t.staff(), "billing_claims": t.claims(),
    "appointments": t.appointments_raw("appointment_id", "appointment_date", "specialty", "patient_gap"),
    "satisfaction_surveys": t.surveys()})["satisfaction_surveys"])
job("c21_referential_checks", lambda t: q.referential_checks({
    "patients": t.patients("patient_id"), "staff": t.staff(), "billing_claims": t.claims(),
    "appointments": t.appointments("appointment_id", "patient_id", "staff_id", "status", "billing_type"),
    "satisfaction_surveys": t.surveys("patient_id", "appointment_id")}))
job("s09_table_profile", lambda t: q.table_profile(
    {"patients": t.patients(), "appointments": t.appointments(), "satisfaction_surveys": t.surveys(),
     "billing_claims": t.claims()}))
