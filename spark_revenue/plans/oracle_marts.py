"""Second opinion in SQL for profitability, segments, features, scores, recommendations, dashboard."""

from ..operators.segmentation import PLAYBOOK
from .oracle_analysis import _ACT, _DAYS, _POINTS, _SAT, LEAK_CTE, LEAK_ROWS, SNAP, _sat_by
from .oracle_base import avg, n, oracle, pct, raw_pct, rnd, total
from .oracle_kpi import BULK, DONE, KPI_BODIES, MARGIN, MISS, TELE, _PIVOT

# --- T ----------------------------------------------------------------------------------------
_PL = f"""pl AS (SELECT specialty, {n(DONE)} AS completed_appointments, {rnd(avg('billed_amount', DONE), 6)} AS avg_billed,
    {rnd(avg('staff_cost', DONE), 6)} AS avg_cost, {rnd(avg(MARGIN, DONE), 6)} AS avg_margin,
    {total('billed_amount', DONE)} AS total_revenue, {total('staff_cost', DONE)} AS total_cost,
    {total(MARGIN, DONE)} AS total_profit, {n(f'{DONE} AND {BULK}')} AS bulk_bill_count,
    {pct(f'sum({MARGIN}) FILTER ({DONE})::DOUBLE', f'sum(billed_amount) FILTER ({DONE})::DOUBLE', 6)} AS margin_pct,
    {pct(n(f'{DONE} AND {BULK}'), n(DONE), 6)} AS bulk_billing_rate, {rnd(avg('wait_days'), 6)} AS avg_wait_days,
    {pct(n(MISS), n(), 6)} AS no_show_rate FROM appointments GROUP BY specialty)"""
_CLIN = f"""cl AS (SELECT clinic_name, state, {n()} AS total_appointments, {total('billed_amount')} AS total_revenue,
    {rnd(avg('wait_days'), 6)} AS avg_wait_days FROM appointments JOIN staff USING (staff_id) WHERE {DONE}
    GROUP BY clinic_name, state),
  cs AS (SELECT clinic_name, st.state, {rnd(avg('overall_score'))} AS avg_satisfaction
    FROM appointments a JOIN staff st ON st.staff_id=a.staff_id JOIN surveys s ON s.appointment_id=a.appointment_id
    WHERE a.{DONE} GROUP BY clinic_name, st.state),
  cp AS (SELECT cl.*, avg_satisfaction FROM cl LEFT JOIN cs USING (clinic_name, state))"""
_SHARE = f"CAST(CAST({MARGIN} AS DOUBLE)/nullif(CAST(billed_amount AS DOUBLE),0) AS DECIMAL(28,10))"
_MARGIN_CHART = f"""SELECT *, CASE WHEN margin_pct > 50 THEN 'green' WHEN margin_pct > 25 THEN 'orange' ELSE 'red' END AS band
    FROM (SELECT specialty, {rnd(avg(MARGIN))} AS avg_margin, {total('billed_amount')} AS total_revenue,
    {rnd(f'({avg(_SHARE)}*100)')} AS margin_pct FROM appointments WHERE {DONE} GROUP BY specialty)"""

# --- R ----------------------------------------------------------------------------------------
_RFV = f"""rf AS (SELECT patient_id, date_diff('day', max(appointment_date), {SNAP}) AS recency,
    count(appointment_id) AS frequency, CAST(round(sum(billed_amount),2) AS DOUBLE) AS value,
    {avg('wait_days')} AS avg_wait_days, date_diff('day', min(appointment_date), {SNAP}) AS days_since_first_appt
    FROM appointments WHERE NOT regexp_matches(lower(status), 'no.show|dna|cancell?ed') GROUP BY patient_id)"""


def _score(x: str) -> str:
    return "+".join(f"CAST({x} > (SELECT quantile_cont({x}::DOUBLE, {p}) FROM rf) AS INTEGER)" for p in (0.25, 0.5, 0.75))


_SCORED = f"""{_RFV}, sc0 AS (SELECT *, 4-({_score('recency')}) AS "R", 1+{_score('frequency')} AS "F",
    1+{_score('value')} AS "V" FROM rf), sc AS (SELECT *, {rnd('(("R"+"F"+"V")/3e0)', 6)} AS "RFV_avg" FROM sc0)"""
_SEG = f"""{_SCORED}, sg AS (SELECT patient_id, recency, frequency, value, {rnd('avg_wait_days', 6)} AS avg_wait_days,
    "R", "F", "V", "RFV_avg", full_name, gender, age, age_group, state, insurance_type, health_fund, chronic_conditions,
    churn_flag, total_appointments, total_billed, coalesce(trim(chronic_conditions),'None') <> 'None' AS has_chronic,
    CASE WHEN least("R","F","V") >= 3 THEN 'Active & Engaged'
      WHEN "F" >= 3 AND coalesce(trim(chronic_conditions),'None') <> 'None' THEN 'Chronic Care Patient'
      WHEN total_appointments <= 2 AND days_since_first_appt < 180 THEN 'New Patient'
      WHEN "F" <= 2 AND avg_wait_days < 20 THEN 'Preventive Only' WHEN "R" <= 2 AND "F" >= 2 THEN 'At Risk of Lapsing'
      WHEN "V" >= 3 AND "F" <= 2 THEN 'High Value Occasional' ELSE 'Disengaged' END AS segment
    FROM sc LEFT JOIN patients USING (patient_id))"""
_OPINION = f"""op AS (SELECT patient_id, {rnd(avg('overall_score'), 6)} AS avg_satisfaction FROM surveys GROUP BY patient_id)"""
# The rule probability of the registered queries.
RULE = f"""{_ACT}, {_SAT}, rp AS (SELECT patient_id, churn_flag, tb AS total_billed,
    {rnd('least(1e0, (points*20e0 + coalesce(ns,0e0)/2e0)/100e0)', 4)} AS churn_probability
    FROM (SELECT *, {_POINTS} AS points FROM (SELECT p.patient_id, churn_flag, p.total_billed::DOUBLE AS tb,
      {_DAYS} AS d, coalesce(act.total_appointments,0) AS v, coalesce(score,5e0) AS sc, no_show_rate_pct AS ns
      FROM patients p LEFT JOIN act USING (patient_id) LEFT JOIN sat USING (patient_id))))"""


def _dec(x: str, p: int = 20, s: int = 6) -> str:
    return f"CAST({x} AS DECIMAL({p},{s}))"


_PROFILE_COLS = f"""segment, {n()} AS patient_count, {rnd(avg(_dec('avg_wait_days')), 4)} AS avg_wait,
    {rnd(avg('total_billed'))} AS avg_billed, {total('total_billed')} AS total_revenue,
    {pct('sum(churn_flag)', 'count(churn_flag)')} AS churn_rate_pct,
    {rnd(avg(_dec('avg_satisfaction')), 4)} AS avg_satisfaction, {rnd(avg('"R"'), 4)} AS avg_r,
    {rnd(avg('"F"'), 4)} AS avg_f, {rnd(avg('"V"'), 4)} AS avg_v,
    {pct('sum(total_billed)::DOUBLE', '(SELECT sum(total_billed)::DOUBLE FROM sg)', 4)} AS revenue_share_pct"""


def _describe(x: str) -> str:
    q = ", ".join(f"{rnd(f'quantile_cont({x}::DOUBLE, {p})', 4)} AS {a}" for a, p in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75)))
    return f"""SELECT '{x}' AS measure, count({x}) AS count, {rnd(avg(f'CAST({x} AS DECIMAL(28,8))'), 4)} AS mean,
        {rnd(f'stddev_samp({x}::DOUBLE)', 4)} AS std, {rnd(f'min({x})', 4)} AS min, {rnd(f'max({x})', 4)} AS max, {q} FROM rf"""


_PLAY = ", ".join("('" + "', '".join(row) + "')" for row in PLAYBOOK)

# --- F ----------------------------------------------------------------------------------------
_FEATURES = f"""WITH a AS (SELECT patient_id, max(appointment_date) AS lv, count(appointment_id) AS c,
      sum(billed_amount)::DOUBLE AS tb, {avg('billed_amount')} AS ab, {avg('wait_days')} AS aw, {n(MISS)} AS ns, {n(TELE)} AS te
      FROM appointments GROUP BY patient_id),
    s AS (SELECT patient_id, {avg('overall_score')} AS os, {avg('wait_time_rating')} AS wr,
      {n("complaint_category <> 'None'")} AS cc FROM surveys GROUP BY patient_id)"""
_FEATURE_ROWS = f"""coalesce({rnd('ab', 6)},0e0) AS avg_billed, coalesce({rnd('aw', 6)},0e0) AS avg_wait_days,
    coalesce({rnd('(ns::DOUBLE/nullif(c,0))', 6)},0e0) AS no_show_rate,
    coalesce({rnd('(te::DOUBLE/nullif(c,0))', 6)},0e0) AS telehealth_rate, coalesce(c,0) AS appointment_count,
    coalesce(cc,0) AS complaint_count"""
_INS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
_STATES = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


def _one_hot(first: int) -> str:
    cols = [f"CAST(insurance_type='{v}' AS INTEGER) AS \"ins_{v}\"" for v in _INS[first:]]
    cols += [f"CAST(state='{v}' AS INTEGER) AS \"state_{v}\"" for v in _STATES[first:]]
    return f"SELECT patient_id, {', '.join(cols)} FROM patients"


_RANKED = """th AS (SELECT *, sum(c) OVER (ORDER BY s DESC) AS above, sum(p) OVER (ORDER BY s DESC) AS tp,
    sum(c) OVER () AS al, sum(p) OVER () AS ap
    FROM (SELECT churn_probability AS s, count(*) AS c, sum(churn_flag) AS p FROM rp GROUP BY 1))"""
_BAND = "CASE WHEN churn_probability < 0.30 THEN 'Low' WHEN churn_probability <= 0.60 THEN 'Medium' ELSE 'High' END"
_AT_RISK = f"""bd AS (SELECT *, {_BAND} AS risk_band FROM rp), ar AS (SELECT *,
    {rnd('(total_billed*churn_probability)', 6)} AS revenue_at_risk FROM bd WHERE churn_flag=0)"""
_RR = _dec("revenue_at_risk", 28)
_TP, _FP = "churn_flag=1 AND churn_probability>=0.5", "churn_flag=0 AND churn_probability>=0.5"
_FN, _TN = "churn_flag=1 AND churn_probability<0.5", "churn_flag=0 AND churn_probability<0.5"


# --- E ----------------------------------------------------------------------------------------
def whole(x: str) -> str:
    return f"format('{{:,}}', CAST({rnd(x, 0)} AS BIGINT))"


def one(x: str) -> str:
    return f"printf('%.1f', {rnd(x, 1)})"


def _rec(category: str, priority: str, metric: str, current: str, target: str, action: str, impact: str, source: str) -> str:
    return f"""SELECT '{category}' AS category, {priority} AS priority, {metric} AS metric, {current} AS current_value,
        {target} AS target_value, {action} AS action, {rnd(impact)} AS estimated_impact_aud FROM {source}"""


_E1 = _rec("Churn Prevention", "'High'", "'High-Risk Patient Count (churn score > 0.60)'",
           f"{whole('n')} || ' patients at high risk, mean lifetime value $' || {whole('(worth/n)')}",
           "'Score under 0.40 once they were called'",
           f"'Call ' || {whole('n')} || ' high-risk patients within 7 days, highest lifetime value first'", "(worth*0.30e0)",
           """(SELECT count(*) AS n, CAST(sum(CAST(total_billed AS DECIMAL(18,2))) AS DOUBLE) AS worth FROM rp
               WHERE churn_probability > 0.6) WHERE n > 0""")
_HIT = "billing_type LIKE '%bulk%'"
_RECENT = f"appointment_date >= {SNAP} - INTERVAL 1 MONTH"
_PRIOR = f"appointment_date < {SNAP} - INTERVAL 1 MONTH AND appointment_date >= {SNAP} - INTERVAL 4 MONTH"
_DROP = f"""(SELECT * FROM (SELECT specialty, {raw_pct(n(f'{_HIT} AND {_RECENT}'), n(_RECENT))} AS a,
    {raw_pct(n(f'{_HIT} AND {_PRIOR}'), n(_PRIOR))} AS b FROM appointments GROUP BY specialty) WHERE b-a > 5)"""
_E2 = _rec("Bulk Billing Optimisation", "if(b-a > 10, 'High', 'Medium')", "'Bulk Billing Rate - ' || specialty",
           f"{one('a')} || '%'", f"{one('b')} || '% (mean of the three months before)'",
           f"'Review billing policy for ' || specialty || ': its rate fell ' || {one('(b-a)')} || '% in a month'", "0e0", _DROP)
_E2C = _rec("Bulk Billing Optimisation", "'Medium'", "'Bulk Billing Rate (all specialties)'",
            "'Every specialty holds its rate'", "'At most 5 points under the three months before'",
            "'Keep specialty, billing type and date with every claim so the trend can be followed'", "0e0",
            f"(SELECT 1) WHERE NOT EXISTS {_DROP}")
_E2B = _rec("Bulk Billing Optimisation", "'Medium'", "'Bulk Billing Rate - ' || specialty", f"{one('a')} || '%'",
            "'70% or more (benchmark)'",
            f"'Review billing policy for ' || specialty || ': its rate of ' || {one('a')} || '% is below the benchmark'", "0e0",
            f"(SELECT specialty, {raw_pct(n(_HIT), n())} AS a FROM appointments GROUP BY specialty) WHERE a < 70")
_E3 = _rec("Wait Time SLA Breaches", "if(w-sla > sla*0.5, 'High', 'Medium')", "'Avg Wait Days - ' || specialty",
           f"{one('w')} || ' days'", "sla || ' days (SLA)'",
           f"'Open more slots for ' || specialty || ': ' || {one('w')} || ' days against an SLA of ' || sla", "0e0",
           f"""(SELECT specialty, {avg('wait_days')} AS w, CASE specialty WHEN 'GP' THEN 7 WHEN 'Cardiology' THEN 21 ELSE 14 END
           AS sla FROM appointments GROUP BY specialty) WHERE w > sla""")
_E4_IMPACT = "(n*12*(r/100-0.10e0)*fee)"
_E4 = _rec("No-Show Reduction", "if(r > 25, 'High', 'Medium')", "'No-Show Rate - ' || specialty", f"{one('r')} || '%'",
           "'10% (benchmark)'",
           f"'Send text reminders for ' || specialty || ': $' || {whole(_E4_IMPACT)} || ' AUD a year from ' || {one('r')} || '% to 10%'",
           _E4_IMPACT, f"""(SELECT specialty, {n()} AS n, {raw_pct(n(MISS), n())} AS r,
           (SELECT {avg('scheduled_fee')} FROM appointments) AS fee FROM appointments GROUP BY specialty) WHERE r > 15""")
_E5 = _rec("Medicare Claim Recovery", "if(leakage_amount > 50000, 'High', 'Medium')", "'Claim Leakage - ' || bucket",
           f"'$' || {whole('leakage_amount')} || ' AUD found missing'",
           f"'$' || {whole('(leakage_amount*0.5e0)')} || ' AUD back if half is fixed'",
           f"'Work through ' || bucket || ': $' || {whole('(leakage_amount*0.5e0)')} || ' AUD recoverable at a 50% fix rate'",
           "(leakage_amount*0.5e0)", "lr WHERE leakage_amount > 10000")
_LR = f"{LEAK_CTE}, lr AS ({LEAK_ROWS})"
_ALL_RECS = f"""WITH {RULE}, {_LR}, ev AS (SELECT 0 AS k, 0e0 AS o, * FROM ({_E1}) UNION ALL SELECT 1, 0e0, * FROM ({_E2})
    UNION ALL SELECT 1, 0e0, * FROM ({_E2C}) UNION ALL SELECT 2, 0e0, * FROM ({_E3}) UNION ALL SELECT 3, 0e0, * FROM ({_E4})
    UNION ALL SELECT 4, -estimated_impact_aud, * FROM ({_E5}))"""

MARTS: dict[str, str] = {
    "t00_completed_with_clinic": f"""SELECT appointment_id, a.staff_id, specialty, status, billed_amount::DOUBLE AS billed_amount,
        staff_cost::DOUBLE AS staff_cost, clinic_name, s.state, clinic_type, ({MARGIN})::DOUBLE AS margin,
        CASE WHEN billed_amount > 0 THEN {pct(f'({MARGIN})::DOUBLE', 'billed_amount::DOUBLE', 4)} ELSE 0e0 END AS margin_pct
        FROM appointments a LEFT JOIN staff s ON s.staff_id=a.staff_id WHERE {DONE}""",
    "t01_specialty_pl": f"WITH {_PL} SELECT * FROM pl",
    "t02_margin_bands": f"""WITH {_PL} SELECT specialty, avg_margin, CASE WHEN avg_margin > 30 THEN 'high'
        WHEN avg_margin > 15 THEN 'mid' ELSE 'low' END AS band FROM pl""",
    "t03_wait_satisfaction": f"""WITH p AS (SELECT specialty, {rnd(avg('wait_days'), 6)} AS avg_wait_days,
          {n(DONE)} AS completed_appointments FROM appointments GROUP BY specialty),
        q AS (SELECT p.*, avg_satisfaction AS avg_overall_score FROM p JOIN {_sat_by('specialty')} USING (specialty))
        SELECT *, (SELECT {rnd('regr_slope(avg_overall_score, avg_wait_days)', 6)} FROM q) AS slope,
        (SELECT {rnd('regr_intercept(avg_overall_score, avg_wait_days)', 6)} FROM q) AS intercept,
        (SELECT {rnd('corr(avg_overall_score, avg_wait_days)', 6)} FROM q) AS correlation FROM q""",
    "t04_clinic_performance": f"WITH {_CLIN} SELECT * FROM cp",
    "t04b_clinic_wait_proxy": f"""WITH {_CLIN}, e AS (SELECT min(avg_wait_days) AS lo, max(avg_wait_days) AS hi FROM cp)
        SELECT cp.*, {rnd('(5e0-(avg_wait_days-lo)/(hi-lo+1e-9)*2e0)', 6)} AS satisfaction_proxy FROM cp, e""",
    "t05_best_and_worst": f"""WITH {_PL} SELECT * FROM (SELECT 'highest_margin' AS finding, specialty, margin_pct AS value
          FROM pl ORDER BY margin_pct DESC, specialty LIMIT 1)
        UNION ALL SELECT * FROM (SELECT 'lowest_margin', specialty, margin_pct FROM pl ORDER BY margin_pct, specialty LIMIT 1)
        UNION ALL SELECT * FROM (SELECT 'longest_wait', specialty, avg_wait_days FROM pl ORDER BY avg_wait_days DESC, specialty LIMIT 1)""",
    "t06_margin_chart": _MARGIN_CHART,
    "r01_rfv": f"WITH {_RFV} SELECT * REPLACE ({rnd('avg_wait_days', 6)} AS avg_wait_days) FROM rf",
    "r01b_describe": f"WITH {_RFV} " + " UNION ALL ".join(_describe(x) for x in ("recency", "frequency", "value", "avg_wait_days")),
    "r02_quartile_scores": f'WITH {_SCORED} SELECT patient_id, "R", "F", "V", "RFV_avg" FROM sc',
    "r03_score_distribution": f"WITH {_SCORED} " + " UNION ALL ".join(
        f"SELECT '{d}' AS measure, \"{d}\" AS score, count(*) AS patients FROM sc GROUP BY 2" for d in "RFV"),
    "r04_segments": f"WITH {_SEG} SELECT * REPLACE (total_billed::DOUBLE AS total_billed) FROM sg",
    "r05_segment_profile": f"WITH {_SEG}, {_OPINION} SELECT {_PROFILE_COLS} FROM sg LEFT JOIN op USING (patient_id) GROUP BY segment",
    "r06_segment_churn": f"""WITH {RULE}, {_SEG}, {_OPINION}
        SELECT {_PROFILE_COLS.replace('total_billed', 'sg.total_billed').replace('churn_flag', 'sg.churn_flag')},
        {rnd(avg(_dec('churn_probability', 20, 10)), 4)} AS avg_churn_prob
        FROM sg LEFT JOIN op USING (patient_id) LEFT JOIN rp ON rp.patient_id=sg.patient_id GROUP BY segment""",
    "r07_export": f"""WITH {RULE}, {_SEG}, {_OPINION} SELECT sg.patient_id, segment, churn_probability, avg_satisfaction
        FROM sg LEFT JOIN op ON op.patient_id=sg.patient_id LEFT JOIN rp ON rp.patient_id=sg.patient_id""",
    "r07b_segment_summary": f"""WITH {_SEG} SELECT segment, {n()} AS patients, {rnd(avg('total_billed'))} AS avg_billed,
        {total('total_billed')} AS total_revenue,
        {pct('sum(total_billed)::DOUBLE', '(SELECT sum(total_billed)::DOUBLE FROM sg)')} AS revenue_share_pct FROM sg GROUP BY segment""",
    "r08_playbook": f"""WITH {_SEG}, pb(segment, priority, actions, kpi_to_watch) AS (VALUES {_PLAY})
        SELECT segment, count(*) AS patients, any_value(priority) AS priority, any_value(actions) AS actions,
        any_value(kpi_to_watch) AS kpi_to_watch FROM sg JOIN pb USING (segment) GROUP BY segment""",
    "r09_segment_sizes": f'WITH {_SEG} SELECT segment, count(*) AS patients, sum("V")::BIGINT AS total_value FROM sg GROUP BY segment',
    "f01_churn_features": f"""{_FEATURES} SELECT p.patient_id, insurance_type, state, chronic_conditions, churn_flag,
        coalesce(tb,0e0) AS total_billed, {_FEATURE_ROWS}, coalesce(ns,0) AS no_show_count, coalesce(te,0) AS telehealth_count,
        coalesce(date_diff('day', lv, {SNAP}),999) AS days_since_visit, coalesce({rnd('os', 6)},5e0) AS avg_overall_score,
        coalesce({rnd('wr', 6)},3e0) AS avg_wait_rating
        FROM patients p LEFT JOIN a USING (patient_id) LEFT JOIN s USING (patient_id)""",
    "f01b_churn_features_wide": f"""{_FEATURES} SELECT p.patient_id, insurance_type, state, chronic_conditions, churn_flag, age,
        total_billed::DOUBLE AS total_billed, {_FEATURE_ROWS}, coalesce(date_diff('day', lv, {SNAP}),0) AS days_since_visit,
        {rnd('coalesce(os, (SELECT quantile_cont(os, 0.5) FROM s))', 6)} AS avg_overall_score,
        {rnd('coalesce(wr, (SELECT quantile_cont(wr, 0.5) FROM s))', 6)} AS avg_wait_rating
        FROM patients p LEFT JOIN a USING (patient_id) LEFT JOIN s USING (patient_id)""",
    "f02_one_hot": _one_hot(0),
    "f02b_one_hot_drop_first": _one_hot(1),
    "f03_condition_flags": """SELECT patient_id, CAST(chronic_conditions LIKE '%Diabetes%' IS TRUE AS INTEGER) AS chronic_diabetes,
        CAST(chronic_conditions LIKE '%Hypertension%' IS TRUE AS INTEGER) AS chronic_hypertension,
        CAST(coalesce(chronic_conditions,'None') = 'None' AS INTEGER) AS chronic_none FROM patients""",
    "f04b_exact_split_sizes": """WITH c AS (SELECT churn_flag, count(*) AS n, CAST(round(count(*)*0.2e0) AS BIGINT) AS t
          FROM patients GROUP BY churn_flag)
        SELECT churn_flag, true AS is_test, t AS n FROM c WHERE t > 0 UNION ALL SELECT churn_flag, false, n-t FROM c WHERE n > t""",
    "f05c_ranking_quality": f"""WITH {RULE}, {_RANKED} SELECT
        {rnd('(CAST(sum((c-p)*(2*tp-p)) AS DOUBLE)/nullif(2*max(ap)*(max(al)-max(ap)),0))', 4)} AS roc_auc,
        {rnd('(sum(p*(tp::DOUBLE/above))/nullif(max(ap),0))', 4)} AS avg_precision FROM th""",
    "f05d_roc_points": f"""WITH {RULE}, {_RANKED} SELECT s AS threshold, {rnd('((above-tp)::DOUBLE/nullif(al-ap,0))', 6)} AS fpr,
        {rnd('(tp::DOUBLE/nullif(ap,0))', 6)} AS tpr FROM th""",
    "f05e_confusion": f"""WITH {RULE}, k AS (SELECT {n(_TP)} AS tp, {n(_FP)} AS fp, {n(_FN)} AS fn, {n(_TN)} AS tn FROM rp)
        SELECT tp AS true_positive, fp AS false_positive, fn AS false_negative, tn AS true_negative,
        {rnd('(tp::DOUBLE/nullif(tp+fp,0))', 4)} AS "precision", {rnd('(tp::DOUBLE/nullif(tp+fn,0))', 4)} AS recall,
        {rnd('((2*tp)::DOUBLE/nullif(2*tp+fp+fn,0))', 4)} AS f1, {rnd('((tp+tn)::DOUBLE/nullif(tp+fp+fn+tn,0))', 4)} AS accuracy FROM k""",
    "f06b_risk_bands": f"WITH {RULE} SELECT *, {_BAND} AS risk_band FROM rp",
    "f07_revenue_at_risk": f"WITH {RULE}, {_AT_RISK} SELECT * FROM ar",
    "f07b_risk_summary": f"""WITH {RULE}, {_AT_RISK} SELECT risk_band, {n()} AS patients,
        {rnd(avg(_dec('churn_probability', 28)), 4)} AS avg_churn_prob, {total(_dec('total_billed', 18, 2))} AS total_billed,
        {rnd(f'CAST(sum({_RR}) AS DOUBLE)')} AS revenue_at_risk FROM ar GROUP BY risk_band""",
    "f07c_risk_totals": f"""WITH {RULE}, {_AT_RISK} SELECT {n()} AS active_patients,
        {rnd(f'CAST(sum({_RR}) AS DOUBLE)')} AS total_revenue_at_risk,
        {rnd(f"CAST(coalesce(sum({_RR}) FILTER (WHERE risk_band='High'),0) AS DOUBLE)")} AS high_risk_revenue FROM ar""",
    "f08_retention_list": f"""WITH {RULE}, {_AT_RISK} SELECT ar.patient_id, full_name, state, insurance_type, health_fund, age,
        chronic_conditions, ar.total_billed, churn_probability, revenue_at_risk FROM ar JOIN patients p ON p.patient_id=ar.patient_id
        WHERE risk_band='High' ORDER BY revenue_at_risk DESC, ar.patient_id LIMIT 20""",
    "f12_band_distribution": f"""WITH {RULE}, {_AT_RISK} SELECT risk_band, {n()} AS patients,
        {pct(n(), '(SELECT count(*) FROM bd)', 1)} AS share_pct FROM bd GROUP BY risk_band""",
    "e01_churn_prevention": f"WITH {RULE} {_E1}",
    "e02_bulk_billing": f"{_E2} UNION ALL {_E2C}",
    "e02b_bulk_billing_no_date": _E2B,
    "e03_wait_sla": _E3,
    "e04_no_show_reduction": _E4,
    "e05_claim_recovery": f"WITH {_LR} {_E5}",
    "e06_recommendations": f"""{_ALL_RECS} SELECT * EXCLUDE (k, o), 'REC-' || lpad(CAST(row_number() OVER (ORDER BY
        CASE priority WHEN 'High' THEN 0 WHEN 'Medium' THEN 1 ELSE 2 END, k, o, metric) AS VARCHAR), 2, '0') AS rec_id FROM ev""",
    "e07_totals": f"""{_ALL_RECS} SELECT count(*) AS n,
        CAST(sum(CAST(round(estimated_impact_aud*100) AS BIGINT)) AS DOUBLE)/100e0 AS total_impact_aud FROM ev""",
    "b00_filter_slice": """SELECT appointment_id, specialty, clinic_id, appointment_type,
        CAST(appointment_date AS VARCHAR) AS appointment_date, wait_days FROM appointments WHERE specialty='ECONOMY'
        AND appointment_type='telehealth' AND appointments.appointment_date BETWEEN DATE '1997-01-01' AND DATE '1998-12-31'""",
    "b01_kpi_cards": f"""SELECT {total('billed_amount', DONE)} AS total_revenue,
        count(DISTINCT appointment_id) FILTER (WHERE {DONE}) AS completed_appointments,
        {pct(n(f'{DONE} AND {BULK}'), n(DONE))} AS bulk_billing_rate, {rnd(avg('wait_days', DONE))} AS avg_wait_days,
        {pct(n(MISS), n())} AS no_show_rate, (SELECT {pct('sum(churn_flag)', n())} FROM patients) AS churn_rate FROM appointments""",
    "b02_revenue_trend": f"""WITH r AS (SELECT month, {pct(n(BULK), n())} AS bulk_billing_rate_pct FROM appointments
          WHERE {DONE} GROUP BY month)
        SELECT v.*, bulk_billing_rate_pct, (SELECT
        {rnd('(CAST(sum(CAST(round(bulk_billing_rate_pct*100) AS BIGINT)) AS DOUBLE)/count(*)/100e0)')} FROM r) AS avg_bulk_rate_pct
        FROM ({_PIVOT}) v JOIN r USING (month)""",
    "b03_wait_chart": KPI_BODIES["k03c_wait_bands"],
    "b04_satisfaction_chart": f"""SELECT *, CASE WHEN recommend_rate > 0.70 THEN 'green' WHEN recommend_rate > 0.55 THEN 'orange'
        ELSE 'red' END AS band FROM ({KPI_BODIES['k05c_satisfaction_monthly']})""",
    "b05_margin_chart": _MARGIN_CHART,
    "b06_churn_chart": f"""SELECT *, CASE WHEN churn_rate > 25 THEN 'red' WHEN churn_rate > 18 THEN 'orange' ELSE 'green' END AS band
        FROM ({KPI_BODIES['k07b_churn_by_state']})""",
    "b08_claims_chart": KPI_BODIES["k08c_claim_rejection_chart"],
    "b09_filter_options": """SELECT DISTINCT 'specialty' AS filter, specialty AS value FROM appointments
        UNION SELECT 'clinic_id', CAST(clinic_id AS VARCHAR) FROM appointments UNION SELECT 'appointment_type', appointment_type
        FROM appointments UNION ALL SELECT 'date_min', CAST(min(appointment_date) AS VARCHAR) FROM appointments
        UNION ALL SELECT 'date_max', CAST(max(appointment_date) AS VARCHAR) FROM appointments""",
}
MARTS["b07_segment_treemap"] = MARTS["r09_segment_sizes"]

MARTS = {name: oracle(body) for name, body in MARTS.items()}
