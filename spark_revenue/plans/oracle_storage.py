"""SQL counterparts of reading, writing and views."""

from .jobs_storage import BROKEN, TOTALS, WORDS
from .oracle_analysis import ANALYSIS
from .oracle_base import oracle
from .oracle_kpi import KPI

_SOURCE = {
    "vw_monthly_revenue": KPI["v01_monthly_revenue"], "vw_churn_risk": ANALYSIS["v02_churn_risk"],
    "vw_billing_leakage": KPI["v03_billing_leakage"], "vw_specialty_scorecard": ANALYSIS["v04_specialty_scorecard"],
    "vw_clinic_performance": ANALYSIS["v05_clinic_performance"], "vw_monthly_revenue_by_type": KPI["v06_monthly_revenue_by_type"],
    "vw_retention_priority": ANALYSIS["v07_retention_priority"],
}
_WHOLE = f"patient_id % {WORDS} <> 0 AND patient_id % {BROKEN} <> 0"

STORAGE: dict[str, str] = {
    "s02_csv_parse": oracle(f"""SELECT * REPLACE (date_of_birth::VARCHAR AS date_of_birth, registration_date::VARCHAR AS registration_date,
        last_visit_date::VARCHAR AS last_visit_date, total_billed::DOUBLE AS total_billed) FROM patients WHERE {_WHOLE}"""),
    "s02b_lines_set_aside": oracle(f"""SELECT 'read' AS lines, count(*) FILTER ({_WHOLE}) AS n FROM patients
        UNION ALL SELECT 'set aside', count(*) FILTER (NOT ({_WHOLE})) FROM patients"""),
    "s08_views": " UNION ALL ".join(
        f"SELECT '{name}' AS view_name, count(*) AS row_count, ({TOTALS[name]})::DECIMAL(38,2)::DOUBLE AS total FROM ({body})"
        for name, body in _SOURCE.items()),
}
