"""Second opinion in SQL for the data-quality queries."""

from .oracle_base import n, oracle, pct

_ISO = "CAST(try_strptime(appointment_date, '%Y-%m-%d') AS DATE)"
_DMY = "CAST(try_strptime(appointment_date, '%d/%m/%Y') AS DATE)"
_PARSED = f"coalesce({_ISO}, {_DMY})"
_LINE = "l_orderkey*8+l_linenumber"
_TITLE = "upper(left(trim(specialty),1))||lower(substr(trim(specialty),2))"


def _nulls(table: str, alias: str, cols: list[str]) -> str:
    parts = [
        f"SELECT '{alias}' AS dataset, '{c}' AS \"column\", {n(f'{c} IS NULL')} AS null_count,"
        f" {pct(n(f'{c} IS NULL'), n())} AS null_pct FROM {table}" for c in cols
    ]
    return " UNION ALL ".join(parts)


_PATIENT_COLS = ["medicare_number", "chronic_conditions", "total_billed", "churn_flag"]
_APPT_COLS = ["patient_gap", "billed_amount", "medicare_rebate", "insurance_paid", "wait_days"]
_SURVEY_COLS = ["overall_score", "nps_score", "wait_time_rating", "doctor_rating", "facility_rating"]
_CLAIM_COLS = ["rejection_reason", "rejected_amount"]


def _repair(days: int) -> str:
    return f"""SELECT {_LINE} AS survey_id, l_orderkey AS appointment_id,
        CAST(CASE WHEN CAST(l_shipdate AS DATE) < CAST(o_orderdate AS DATE) THEN CAST(o_orderdate AS DATE) + {days}
        ELSE CAST(l_shipdate AS DATE) END AS VARCHAR) AS survey_date
        FROM lineitem LEFT JOIN orders ON o_orderkey=l_orderkey"""


def _median(col: str) -> str:
    return f"coalesce(CAST({col} AS DOUBLE), (SELECT CAST(median({col}) AS DOUBLE) FROM surveys)) AS {col}"


def _orphans(name: str, child: str, key: str, parent: str) -> str:
    return (f"SELECT 'orphan {name}.{key}' AS \"check\", count(*) AS violations FROM {child} c"
            f" WHERE c.{key} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{key}=c.{key})")


def _unlisted(name: str, table: str, key: str, values: str) -> str:
    return (f"SELECT 'unlisted {name}.{key}' AS \"check\", {n(f'{key} NOT IN ({values})')} AS violations FROM {table}")


_CLEAN = f"""SELECT DISTINCT * REPLACE ({_PARSED} AS appointment_date) FROM appointments_raw"""
_A1 = "(SELECT appointment_id, min(appointment_date) AS appointment_date FROM appointments GROUP BY appointment_id)"

QUALITY: dict[str, str] = {
    "c01_null_audit": f"""SELECT {n()} AS total_appointments, {n('patient_gap IS NULL')} AS null_patient_gap,
        {n('billed_amount IS NULL')} AS null_billed_amount, {n('medicare_rebate IS NULL')} AS null_medicare_rebate,
        {n('appointment_date IS NULL')} AS null_appointment_date, {n('wait_days IS NULL')} AS null_wait_days,
        {n('status IS NULL')} AS null_status FROM appointments""",
    "c01b_survey_null_audit": f"""SELECT {n()} AS total_surveys, {n('overall_score IS NULL')} AS null_overall_score,
        {n('wait_time_rating IS NULL')} AS null_wait_time_rating, {n('doctor_rating IS NULL')} AS null_doctor_rating,
        {pct(n('overall_score IS NULL'), n())} AS null_overall_pct FROM surveys""",
    "c01c_null_summary": f"""SELECT * FROM ({_nulls('patients', 'patients', _PATIENT_COLS)} UNION ALL
        {_nulls('appointments', 'appointments', _APPT_COLS)} UNION ALL {_nulls('surveys', 'surveys', _SURVEY_COLS)}
        UNION ALL {_nulls('claims', 'claims', _CLAIM_COLS)}) WHERE null_count > 0""",
    "c02_duplicate_keys": """SELECT appointment_id, count(*) AS occurrences FROM appointments
        GROUP BY appointment_id HAVING count(*) > 1""",
    "c02b_full_duplicates": """SELECT a AS rows_before, d AS rows_after, a-d AS rows_removed FROM
        (SELECT (SELECT count(*) FROM appointments_raw) AS a,
                (SELECT count(*) FROM (SELECT DISTINCT * FROM appointments_raw)) AS d)""",
    "c03_specialty_spellings": "SELECT specialty, count(*) AS row_count FROM appointments_raw GROUP BY specialty",
    "c04_impossible_dates": f"""SELECT {_LINE} AS survey_id, l_orderkey AS appointment_id,
        CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS appointment_date,
        CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS survey_date
        FROM lineitem JOIN orders ON o_orderkey=l_orderkey WHERE CAST(l_shipdate AS DATE) < CAST(o_orderdate AS DATE)""",
    "c04b_impossible_date_count": """SELECT count(*) AS impossible_dates FROM lineitem JOIN orders
        ON o_orderkey=l_orderkey WHERE CAST(l_shipdate AS DATE) < CAST(o_orderdate AS DATE)""",
    "c05_identifier_digits": """SELECT patient_id, medicare_number FROM patients
        WHERE NOT regexp_full_match(medicare_number, '[0-9]{10}')""",
    "c05b_identifier_mark": """SELECT patient_id, medicare_number FROM patients
        WHERE position('INVALID-' IN medicare_number) > 0""",
    "c06_negative_money": """SELECT appointment_id, billed_amount::DOUBLE AS billed_amount,
        medicare_rebate::DOUBLE AS medicare_rebate, patient_gap::DOUBLE AS patient_gap,
        insurance_paid::DOUBLE AS insurance_paid FROM appointments
        WHERE least(billed_amount, medicare_rebate, coalesce(patient_gap,0), insurance_paid) < 0""",
    "c06b_negative_balances": """SELECT patient_id, total_billed::DOUBLE AS total_billed FROM patients
        WHERE total_billed < 0""",
    "c07_fill_gap": "SELECT appointment_id, coalesce(patient_gap,0)::DOUBLE AS patient_gap FROM appointments",
    "c08_first_per_key": """SELECT appointment_id, CAST(appointment_date AS VARCHAR) AS appointment_date, wait_days,
        scheduled_fee::DOUBLE AS scheduled_fee, patient_gap::DOUBLE AS patient_gap FROM appointments
        QUALIFY row_number() OVER (PARTITION BY appointment_id ORDER BY appointments.appointment_date, wait_days,
        appointments.scheduled_fee, appointments.patient_gap NULLS FIRST) = 1""",
    "c08b_drop_full_duplicates": """SELECT DISTINCT appointment_id, patient_id, specialty, appointment_date,
        scheduled_fee::DOUBLE AS scheduled_fee FROM appointments_raw""",
    "c09_canonical_keep": "SELECT specialty, count(*) AS row_count FROM appointments_raw GROUP BY specialty",
    "c09b_canonical_title": f"SELECT {_TITLE} AS specialty, count(*) AS row_count FROM appointments_raw GROUP BY 1",
    "c09c_canonical_mapped": f"""SELECT CASE lower(trim(specialty)) WHEN 'economy' THEN 'Economy Class'
        WHEN 'standard' THEN 'Standard Class' ELSE {_TITLE} END AS specialty, count(*) AS row_count
        FROM appointments_raw GROUP BY 1""",
    "c10_parse_dates": f"SELECT appointment_id, CAST({_PARSED} AS VARCHAR) AS appointment_date FROM appointments_raw",
    "c10b_unparsed_dates": f"""SELECT {n()} AS total_rows, {n(f'{_PARSED} IS NULL')} AS unparsed
        FROM appointments_raw""",
    "c11_repair_dates_3": _repair(3),
    "c11b_repair_dates_1": _repair(1),
    "c11c_recount_after_repair": f"""SELECT {n('CAST(r.survey_date AS DATE) < CAST(o_orderdate AS DATE)')}
        AS impossible_dates FROM ({_repair(1)}) r JOIN orders ON o_orderkey=r.appointment_id""",
    "c12_fill_medians": f"""SELECT survey_id, {_median('overall_score')}, {_median('wait_time_rating')},
        {_median('doctor_rating')} FROM surveys""",
    "c12b_fill_score_median": f"SELECT survey_id, {_median('overall_score')} FROM surveys",
    "c13_flag_identifiers": """SELECT patient_id, medicare_number, medicare_number NOT LIKE '%INVALID-%'
        AS medicare_number_valid, CAST(medicare_number LIKE '%INVALID-%' AS INTEGER) AS invalid_medicare_flag
        FROM patients""",
    "c14_impossible_ages": f"SELECT {n('age NOT BETWEEN 0 AND 120')} AS impossible_ages FROM patients",
    "c15_validation_scorecard": f"""SELECT 'appointments' AS table_name, {n()} AS total_rows,
          {n('patient_gap IS NULL')} AS null_issues, {n('billed_amount < 0')} AS negative_values,
          0::BIGINT AS impossible_dates FROM appointments
        UNION ALL SELECT 'satisfaction_surveys', {n()}, {n('overall_score IS NULL')}, 0,
          {n('survey_date < a.appointment_date')} FROM surveys LEFT JOIN {_A1} a USING (appointment_id)
        UNION ALL SELECT 'patients', {n()}, {n("medicare_number LIKE '%INVALID-%'")}, 0,
          {n('age NOT BETWEEN 0 AND 120')} FROM patients""",
    "c16_shape_comparison": f"""WITH k AS ({_CLEAN.replace('*', '* EXCLUDE (staff_id, clinic_id, appointment_type, wait_days, status, billing_type, scheduled_fee, staff_cost)', 1)}),
        r AS (SELECT 'patients' AS dataset, (SELECT count(*) FROM patients) AS a, (SELECT count(*) FROM patients) AS b, 2 AS c, 4 AS d
          UNION ALL SELECT 'staff', (SELECT count(*) FROM staff), (SELECT count(*) FROM staff), 11, 11
          UNION ALL SELECT 'appointments', (SELECT count(*) FROM appointments_raw), (SELECT count(*) FROM k), 8, 8
          UNION ALL SELECT 'satisfaction_surveys', (SELECT count(*) FROM surveys), (SELECT count(*) FROM surveys), 11, 11
          UNION ALL SELECT 'billing_claims', (SELECT count(*) FROM claims), (SELECT count(*) FROM claims), 10, 10)
        SELECT dataset, a AS rows_raw, b AS rows_clean, c AS cols_raw, d AS cols_clean, a-b AS rows_removed,
        d-c AS cols_added FROM r""",
    "c17_fix_summary": f"""WITH k AS ({_CLEAN.replace('*', '* EXCLUDE (staff_id, clinic_id, appointment_type, wait_days, status, billing_type, scheduled_fee, staff_cost)', 1)}),
        d0 AS (SELECT appointment_id, min({_ISO}) AS d FROM appointments_raw GROUP BY 1),
        bad AS (SELECT count(*) FILTER (survey_date < d) AS c FROM surveys LEFT JOIN d0 USING (appointment_id))
        SELECT 1 AS fix, 'appointments' AS dataset, 'NULL patient_gap' AS issue,
          (SELECT {n('patient_gap IS NULL')} FROM appointments_raw) AS "before", 0::BIGINT AS "after"
        UNION ALL SELECT 2, 'appointments', 'rows before and after removing full copies',
          (SELECT count(*) FROM appointments_raw), (SELECT count(*) FROM k)
        UNION ALL SELECT 3, 'appointments', 'specialty spellings',
          (SELECT count(DISTINCT specialty) FROM appointments_raw), (SELECT count(DISTINCT {_TITLE}) FROM appointments_raw)
        UNION ALL SELECT 4, 'surveys', 'NULL overall_score', (SELECT {n('overall_score IS NULL')} FROM surveys), 0
        UNION ALL SELECT 5, 'surveys', 'survey before its visit', (SELECT c FROM bad), 0
        UNION ALL SELECT 6, 'patients', 'invalid identifiers found and flagged',
          (SELECT {n("medicare_number LIKE '%INVALID-%'")} FROM patients),
          (SELECT {n("medicare_number LIKE '%INVALID-%'")} FROM patients)
        UNION ALL SELECT 7, 'appointments', 'dates not readable as ISO',
          (SELECT {n(f'{_ISO} IS NULL')} FROM appointments_raw), (SELECT {n('appointment_date IS NULL')} FROM k)""",
    "c18_tracked_nulls": " UNION ALL ".join(
        [f"""SELECT 'appointments' AS dataset, '{c}' AS "column", {n(f'{c} IS NULL')} AS "before",
            {'0::BIGINT' if c == 'patient_gap' else n(f'{c} IS NULL')} AS "after" FROM appointments_raw"""
         for c in ["patient_gap", "billed_amount", "medicare_rebate", "insurance_paid"]]
        + [f"""SELECT 'satisfaction_surveys', '{c}', {n(f'{c} IS NULL')},
            {'0::BIGINT' if c == 'overall_score' else n(f'{c} IS NULL')} FROM surveys"""
           for c in ["overall_score", "wait_time_rating", "doctor_rating", "facility_rating"]]),
    "c19_amount_from_text": """SELECT appointment_id, CASE WHEN appointment_id % 1001 = 1 THEN 0e0
        ELSE scheduled_fee::DOUBLE END AS fee FROM appointments""",
    "c20_clean_appointments": f"""SELECT appointment_id, patient_id, staff_id, clinic_id,
        CAST(appointment_date AS VARCHAR) AS appointment_date, {_TITLE} AS specialty, appointment_type, wait_days,
        status, billing_type, scheduled_fee::DOUBLE AS scheduled_fee, billed_amount::DOUBLE AS billed_amount,
        medicare_rebate::DOUBLE AS medicare_rebate, coalesce(patient_gap,0)::DOUBLE AS patient_gap,
        insurance_paid::DOUBLE AS insurance_paid, staff_cost::DOUBLE AS staff_cost FROM ({_CLEAN})""",
    "c20b_clean_surveys": f"""WITH d AS (SELECT appointment_id, min({_PARSED}) AS visit FROM appointments_raw
        GROUP BY appointment_id)
        SELECT survey_id, patient_id, s.appointment_id, CAST(CASE WHEN survey_date < visit THEN visit + 1
        ELSE survey_date END AS VARCHAR) AS survey_date, {_median('overall_score')}, wait_time_rating, doctor_rating,
        facility_rating, would_recommend, nps_score, complaint_category
        FROM surveys s LEFT JOIN d USING (appointment_id)""",
    "c21_referential_checks": " UNION ALL ".join([
        _orphans("appointments", "appointments", "patient_id", "patients"),
        _orphans("appointments", "appointments", "staff_id", "staff"),
        _orphans("satisfaction_surveys", "surveys", "patient_id", "patients"),
        _orphans("satisfaction_surveys", "surveys", "appointment_id", "appointments"),
        _orphans("billing_claims", "claims", "patient_id", "patients"),
        _orphans("billing_claims", "claims", "appointment_id", "appointments"),
        _unlisted("appointments", "appointments", "status", "'completed','no_show','cancelled','rescheduled'"),
        _unlisted("appointments", "appointments", "billing_type", "'bulk_bill','gap_payment','private','self_pay'"),
        _unlisted("billing_claims", "claims", "claim_type", "'Medicare','Private_Insurance','Self_Pay'"),
        _unlisted("billing_claims", "claims", "claim_status", "'approved','rejected','partial','unpaid','paid'"),
    ]),
    "s09_table_profile": f"""SELECT 'patients' AS dataset, count(*) AS rows, 19 AS cols,
          {n('chronic_conditions IS NULL')} AS total_nulls FROM patients
        UNION ALL SELECT 'appointments', count(*), 16, {n('patient_gap IS NULL')} FROM appointments
        UNION ALL SELECT 'satisfaction_surveys', count(*), 11, 2*{n('overall_score IS NULL')} FROM surveys
        UNION ALL SELECT 'billing_claims', count(*), 10, {n('rejection_reason IS NULL')} FROM claims""",
}

QUALITY = {name: oracle(body) for name, body in QUALITY.items()}
