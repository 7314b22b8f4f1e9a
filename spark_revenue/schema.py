"""Explicit schemas and value lists of the five domain tables."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)


def _struct(spec: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in spec])


_I, _L, _S, _D = T.IntegerType(), T.LongType(), T.StringType(), T.DateType()

PATIENTS = _struct([
    ("patient_id", _L), ("full_name", _S), ("gender", _S), ("age", _I), ("age_group", _S),
    ("date_of_birth", _D), ("state", _S), ("city", _S), ("postcode", _S), ("medicare_number", _S),
    ("insurance_type", _S), ("health_fund", _S), ("chronic_conditions", _S), ("referral_source", _S),
    ("registration_date", _D), ("last_visit_date", _D), ("churn_flag", _I), ("total_appointments", _I),
    ("total_billed", MONEY),
])

STAFF = _struct([
    ("staff_id", _L), ("full_name", _S), ("role", _S), ("specialty", _S), ("clinic_id", _L),
    ("clinic_name", _S), ("city", _S), ("state", _S), ("clinic_type", _S), ("years_experience", _I),
    ("avg_patient_rating", T.DecimalType(3, 1)),
])

APPOINTMENTS = _struct([
    ("appointment_id", _L), ("patient_id", _L), ("staff_id", _L), ("clinic_id", _L),
    ("appointment_date", _D), ("specialty", _S), ("appointment_type", _S), ("wait_days", _I),
    ("status", _S), ("billing_type", _S), ("scheduled_fee", MONEY), ("billed_amount", MONEY),
    ("medicare_rebate", MONEY), ("patient_gap", MONEY), ("insurance_paid", MONEY), ("staff_cost", MONEY),
])

SATISFACTION_SURVEYS = _struct([
    ("survey_id", _L), ("patient_id", _L), ("appointment_id", _L), ("survey_date", _D),
    ("specialty", _S), ("overall_score", _I), ("wait_time_rating", _I), ("doctor_rating", _I),
    ("facility_rating", _I), ("would_recommend", _I), ("nps_score", _I), ("complaint_category", _S),
])

BILLING_CLAIMS = _struct([
    ("claim_id", _L), ("appointment_id", _L), ("patient_id", _L), ("claim_date", _D),
    ("claim_type", _S), ("claimed_amount", MONEY), ("approved_amount", MONEY),
    ("rejected_amount", MONEY), ("claim_status", _S), ("rejection_reason", _S),
])

# Parents first, so a loader that writes in this order never leaves a child without its parent.
TABLES: dict[str, T.StructType] = {
    "patients": PATIENTS,
    "staff": STAFF,
    "appointments": APPOINTMENTS,
    "satisfaction_surveys": SATISFACTION_SURVEYS,
    "billing_claims": BILLING_CLAIMS,
}

# Fixed values.
STATUSES = ["completed", "no_show", "cancelled", "rescheduled"]
BILLING_TYPES = ["bulk_bill", "gap_payment", "private", "self_pay"]
CLAIM_TYPES = ["Medicare", "Private_Insurance", "Self_Pay"]
CLAIM_STATUSES = ["approved", "rejected", "partial", "unpaid", "paid"]
