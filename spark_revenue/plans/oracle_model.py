"""SQL counterparts of encoder, folds, report and the linear model."""

from ..operators.recommend import PATTERNS
from ..sources.binding import _APPOINTMENT_COLUMNS, _CLAIM_EXPRS, _PATIENT_EXPRS, _STAFF_EXPRS, _SURVEY_EXPRS
from .jobs_marts import CLINICAL, FIXED_BASE, FIXED_COEFFICIENTS
from .oracle_base import oracle, rnd
from .oracle_marts import _BAND, _E2, _E2C, _E3, MARTS, RULE

_PARTS = """(SELECT patient_id, unnest(list_distinct(list_transform(string_split_regex(coalesce(chronic_conditions, ''), '[;,]'),
    lambda x: trim(x)))) AS part FROM {0})"""


def _tokens(table: str) -> str:
    """(patient_id, v): category values with their prefixes."""
    return f"""SELECT patient_id, 'insurance_type_' || insurance_type AS v FROM {table} WHERE insurance_type IS NOT NULL
        UNION ALL SELECT patient_id, 'state_' || state FROM {table} WHERE state IS NOT NULL
        UNION ALL SELECT patient_id, 'chronic_conditions_' || part FROM {_PARTS.format(table)} WHERE part <> ''"""


_DICTIONARY = f"""tok AS ({_tokens('patients')}),
    dict AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS i, n FROM (SELECT v, count(*) AS n FROM tok GROUP BY v))"""


def _report(source: str) -> str:
    """Per class from one-against-rest counts, then the three lines of means."""
    return f"""pr AS ({source}), cl AS (SELECT t AS c FROM pr UNION SELECT s FROM pr),
    k AS (SELECT c, (SELECT count(*) FROM pr WHERE t = c) AS support, (SELECT count(*) FROM pr WHERE s = c) AS said,
      (SELECT count(*) FROM pr WHERE t = c AND s = c) AS hits FROM cl),
    m AS (SELECT c, coalesce(hits/nullif(said::DOUBLE, 0), 0e0) AS p, coalesce(hits/nullif(support::DOUBLE, 0), 0e0) AS r,
      coalesce((2*hits)/nullif((said + support)::DOUBLE, 0), 0e0) AS f, support, hits FROM k),
    d AS (SELECT *, CAST(p AS DECIMAL(20,12)) AS dp, CAST(r AS DECIMAL(20,12)) AS dr, CAST(f AS DECIMAL(20,12)) AS df FROM m),
    u AS (SELECT c AS class, p, r, f, support FROM m
      UNION ALL SELECT 'accuracy', sum(hits)/sum(support)::DOUBLE, sum(hits)/sum(support)::DOUBLE, sum(hits)/sum(support)::DOUBLE, sum(support) FROM d
      UNION ALL SELECT 'macro avg', sum(dp)::DOUBLE/count(*), sum(dr)::DOUBLE/count(*), sum(df)::DOUBLE/count(*), sum(support) FROM d
      UNION ALL SELECT 'weighted avg', sum(dp*support)::DOUBLE/sum(support), sum(dr*support)::DOUBLE/sum(support),
        sum(df*support)::DOUBLE/sum(support), sum(support) FROM d)
    SELECT class, {rnd('p', 4)} AS "precision", {rnd('r', 4)} AS recall, {rnd('f', 4)} AS f1,
      support::BIGINT AS support FROM u WHERE support IS NOT NULL"""


_NUMBERS = [f for f, *_ in FIXED_COEFFICIENTS if not f.startswith(("state_", "insurance_", "chronic_", "never_"))]
_VALUES = ", ".join(f"('{f}', {m}::DOUBLE, {s}::DOUBLE, {c}::DOUBLE)" for f, m, s, c in FIXED_COEFFICIENTS)
_DENSE = " UNION ALL ".join(f"SELECT patient_id, '{c}' AS feature, {c}::DOUBLE AS x FROM fe" for c in _NUMBERS)
# Dense here: every patient with every feature, 0 where a category is absent.
_LINEAR = f"""fe AS ({MARTS['f01_churn_features']}), co(feature, mu, sd, coef) AS (VALUES {_VALUES}),
    lf AS ({_DENSE} UNION ALL SELECT patient_id, v, 1e0 FROM ({_tokens('fe')})),
    ad AS (SELECT fe.patient_id, co.feature, CAST(coalesce((coalesce(x, 0e0) - mu)*coef/nullif(sd, 0), 0e0) AS DECIMAL(28,12)) AS a
      FROM fe CROSS JOIN co LEFT JOIN lf ON lf.patient_id = fe.patient_id AND lf.feature = co.feature),
    sc AS (SELECT patient_id, 1/(1 + exp(-({FIXED_BASE} + sum(a))::DOUBLE)) AS pr FROM ad GROUP BY patient_id)"""

_VISITS = f"""visits AS (SELECT * REPLACE ({CLINICAL}[1 + staff_id % {len(CLINICAL)}] AS specialty,
    CASE WHEN appointment_date >= (SELECT max(appointment_date) FROM appointments) - INTERVAL 1 MONTH AND (staff_id % 4 = 0 OR (staff_id % 4 = 2 AND appointment_id % 3 = 0))
      THEN 'private' ELSE billing_type END AS billing_type) FROM appointments)"""
_HAS = {
    "patients": ("patients", _PATIENT_EXPRS), "staff": ("staff", _STAFF_EXPRS), "appointments": ("appointments", _APPOINTMENT_COLUMNS),
    "satisfaction_surveys": ("surveys", _SURVEY_EXPRS), "billing_claims": ("claims", _CLAIM_EXPRS),
}
# Columns that the view of staff leaves out: all NULL, or never.
_ABSENT = {("staff", "role"): "*", ("staff", "specialty"): "NULL", ("staff", "city"): "*", ("staff", "years_experience"): "*"}
_COLUMNS_SQL = " UNION ALL ".join(
    f"SELECT '{name}' AS t, {i} AS pos, '{c}' AS c, count({_ABSENT.get((name, c), c)}) AS filled FROM {view}"
    for name, (view, columns) in _HAS.items() for i, c in enumerate(columns))
_KINDS = ", ".join(f"('{k}', '{p}')" for k, v in PATTERNS.items() for p in v)

MODEL: dict[str, str] = {
    "e02d_bulk_billing_drop": f"WITH {_VISITS} " + f"{_E2} UNION ALL {_E2C}".replace("FROM appointments", "FROM visits"),
    "e03b_wait_sla_levels": f"WITH {_VISITS} " + _E3.replace("FROM appointments", "FROM visits"),
    "e08_column_discovery": f"""WITH co AS ({_COLUMNS_SQL}), ki(kind, pat) AS (VALUES {_KINDS}),
        hit AS (SELECT DISTINCT t, kind, pos, c, filled FROM co, ki WHERE contains(c, pat)),
        r AS (SELECT *, row_number() OVER (PARTITION BY t, kind ORDER BY filled = 0, pos) AS k, count(*) OVER (PARTITION BY t, kind) AS hits FROM hit)
        SELECT t AS table_name, kind, c AS column_name, hits, filled FROM r WHERE k = 1""",
    "f02d_dictionary": f"WITH {_DICTIONARY} SELECT v AS value, i AS \"index\", n AS \"rows\" FROM dict",
    "f02c_sparse_codes": f"""WITH {_DICTIONARY} SELECT p.patient_id, (SELECT count(*) FROM dict) AS size,
        coalesce(string_agg(i::VARCHAR, ',' ORDER BY i), '') AS indices, coalesce(string_agg('1.0', ','), '') AS "values"
        FROM patients p LEFT JOIN tok USING (patient_id) LEFT JOIN dict USING (v) GROUP BY p.patient_id""",
    "f05g_folds": """SELECT patient_id, churn_flag, CAST((row_number() OVER (PARTITION BY churn_flag
        ORDER BY md5('42:' || patient_id), patient_id) - 1) % 5 AS INTEGER) AS fold FROM patients""",
    "f05j_fold_sizes": """WITH c AS (SELECT churn_flag, count(*) AS n FROM patients GROUP BY churn_flag)
        SELECT churn_flag, CAST(i AS INTEGER) AS fold, n // 5 + CAST(i < n % 5 AS BIGINT) AS "rows" FROM c, range(5) x(i)
        WHERE n // 5 + CAST(i < n % 5 AS BIGINT) > 0""",
    "f05h_classification_report": "WITH {}, {}".format(RULE, _report(
        "SELECT churn_flag::VARCHAR AS t, (churn_probability >= 0.5)::INTEGER::VARCHAR AS s FROM rp")),
    "f05k_band_report": "WITH {}, {}".format(RULE, _report(
        f"SELECT CASE WHEN churn_flag = 1 THEN 'High' WHEN total_billed > 0 THEN 'Medium' ELSE 'Low' END AS t, {_BAND} AS s FROM rp")),
    "f06c_linear_scores": f"WITH {_LINEAR} SELECT patient_id, {rnd('pr', 4)} AS churn_probability FROM sc",
    "f10b_linear_attribution": f"""WITH {_LINEAR} SELECT feature, {rnd('(sum(abs(a))::DOUBLE/count(*))', 6)} AS mean_abs_contribution
        FROM ad GROUP BY feature ORDER BY 2 DESC, 1 LIMIT 15""",
    "f11b_linear_explanation": f"""WITH {_LINEAR}, best AS (SELECT patient_id FROM sc ORDER BY {rnd('pr', 4)} DESC, patient_id LIMIT 1)
        SELECT patient_id, feature, {rnd('a::DOUBLE', 6)} AS contribution, {FIXED_BASE}::DOUBLE AS base_value
        FROM ad WHERE patient_id = (SELECT patient_id FROM best)""",
}

MODEL = {name: oracle(body) for name, body in MODEL.items()}
