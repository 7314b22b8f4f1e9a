"""Second opinion in SQL for the KPI queries."""

from .oracle_base import avg, n, oracle, pct, raw_pct, rnd, total

DONE, MISS, BULK = "status='completed'", "status='no_show'", "billing_type='bulk_bill'"
REJ, TELE = "claim_status='rejected'", "appointment_type='telehealth'"
MARGIN = "billed_amount-staff_cost"
_FIRST = "(SELECT min(appointment_date) FROM appointments)"
MONTH_NUM = f"date_diff('month', {_FIRST}, appointment_date)+1"


def _type(t: str) -> str:
    return total("billed_amount", f"{DONE} AND billing_type='{t}'")


_PIVOT = f"""SELECT month, {_type('bulk_bill')} AS bulk_bill, {_type('gap_payment')} AS gap_payment,
    {_type('private')} AS private, {_type('self_pay')} AS self_pay FROM appointments WHERE {DONE} GROUP BY month"""

_WAIT_ALL = f"""SELECT specialty, {rnd(avg('wait_days'), 1)} AS avg_wait,
    {rnd('median(wait_days)', 1)} AS median_wait, {n()} AS n_appts FROM appointments GROUP BY specialty"""
_CHURN_STATE = f"""SELECT state, {n()} AS total_patients, sum(churn_flag)::BIGINT AS churned,
    {pct('sum(churn_flag)', n(), 1)} AS churn_rate, {rnd(avg('total_billed'))} AS avg_billed,
    (SELECT {pct('sum(churn_flag)', n())} FROM patients) AS overall_churn_rate FROM patients GROUP BY state"""
_VISIT = f"""SELECT specialty, {n(DONE)} AS completed, {rnd(avg('billed_amount', DONE))} AS avg_billed,
    {rnd(avg('staff_cost', DONE))} AS avg_cost, {rnd(avg(MARGIN, DONE))} AS avg_margin,
    {rnd(f"(100e0*{avg(MARGIN, DONE)}/nullif({avg('billed_amount', DONE)},0))")} AS margin_pct
    FROM appointments GROUP BY specialty"""

KPI_BODIES: dict[str, str] = {
    "k01_monthly_revenue": f"""SELECT month, {n(DONE)} AS completed_appointments, {n(MISS)} AS no_shows,
        {total('billed_amount', DONE)} AS gross_revenue, {_type('bulk_bill')} AS bulk_bill_revenue,
        {_type('gap_payment')} AS gap_payment_revenue, {_type('private')} AS private_revenue,
        {_type('self_pay')} AS self_pay_revenue FROM appointments GROUP BY month""",
    "k01b_revenue_pivot": _PIVOT,
    "k01c_revenue_share": f"""WITH m AS (SELECT month, round(coalesce(sum(billed_amount) FILTER ({BULK}),0),2) b,
        round(coalesce(sum(billed_amount) FILTER (billing_type='gap_payment'),0),2) g,
        round(coalesce(sum(billed_amount) FILTER (billing_type='private'),0),2) p,
        round(coalesce(sum(billed_amount) FILTER (billing_type='self_pay'),0),2) s
        FROM appointments WHERE {DONE} GROUP BY month)
        SELECT month, b::DOUBLE AS bulk_bill, g::DOUBLE AS gap_payment, p::DOUBLE AS private, s::DOUBLE AS self_pay,
        (b+g+p+s)::DOUBLE AS total, {pct('b::DOUBLE', '(b+g+p+s)::DOUBLE')} AS bulk_share_pct FROM m""",
    "k02_bulk_billing_rate": f"""SELECT month, {n(DONE)} AS total_completed, {n(f'{DONE} AND {BULK}')} AS bulk_billed,
        {pct(n(f'{DONE} AND {BULK}'), n(DONE))} AS bulk_billing_rate_pct FROM appointments GROUP BY month""",
    "k02b_bulk_rate_all_visits": f"""SELECT month, {n()} AS total_completed, {n(BULK)} AS bulk_billed,
        {pct(n(BULK), n())} AS bulk_billing_rate_pct FROM appointments GROUP BY month""",
    "k03_wait_by_specialty": f"""SELECT specialty, {n()} AS appointments, {rnd(avg('wait_days'), 1)} AS avg_wait_days,
        {rnd('median(wait_days)', 1)} AS median_wait_days, max(wait_days) AS max_wait_days,
        {n('wait_days > 30')} AS long_wait_count, {pct(n('wait_days > 30'), n())} AS long_wait_pct
        FROM appointments WHERE {DONE} GROUP BY specialty""",
    "k03b_wait_all_statuses": _WAIT_ALL,
    "k03c_wait_bands": f"""WITH w AS (SELECT specialty, {avg('wait_days')} AS a, {n()} AS appts FROM appointments
        WHERE {DONE} GROUP BY specialty) SELECT specialty, {rnd('a')} AS avg_wait, appts,
        CASE WHEN a > 30 THEN 'red' WHEN a > 14 THEN 'orange' ELSE 'green' END AS band FROM w""",
    "k04_no_show_by_specialty": f"""SELECT month, specialty, {n()} AS total_appointments, {n(MISS)} AS no_shows,
        {pct(n(MISS), n())} AS no_show_rate_pct, {total('scheduled_fee', MISS)} AS lost_revenue
        FROM appointments GROUP BY month, specialty""",
    "k04b_no_show_trend": f"""WITH m AS (SELECT {MONTH_NUM} AS month_num, {n()} AS total, {n(MISS)} AS no_show,
        {pct(n(MISS), n())} AS noshow_rate FROM appointments GROUP BY 1)
        SELECT *, (SELECT {rnd("(CAST(sum(CAST(round(noshow_rate*100) AS BIGINT)) AS DOUBLE)/count(*)/100e0)")} FROM m)
        AS period_avg_rate FROM m""",
    "k05_satisfaction_trend": f"""SELECT month, {n()} AS surveys, {rnd(avg('overall_score'))} AS avg_overall,
        {rnd(avg('wait_time_rating'))} AS avg_wait_rating, {rnd(avg('doctor_rating'))} AS avg_doctor_rating,
        {pct('sum(would_recommend)', n())} AS recommend_rate_pct, {rnd(avg('nps_score'))} AS avg_nps,
        {n("complaint_category <> 'None'")} AS complaints FROM surveys GROUP BY month""",
    "k05b_satisfaction_by_visit_month": f"""WITH a AS (SELECT appointment_id, min({MONTH_NUM}) AS month_num
        FROM appointments GROUP BY appointment_id)
        SELECT month_num, {rnd(avg('overall_score'))} AS avg_score, {n()} AS n_surveys,
        {rnd(avg('nps_score'))} AS avg_nps FROM surveys JOIN a USING (appointment_id) GROUP BY month_num""",
    "k05c_satisfaction_monthly": f"""SELECT month, {rnd(avg('overall_score'))} AS avg_overall,
        {rnd(avg('would_recommend'), 4)} AS recommend_rate FROM surveys GROUP BY month""",
    "k06_revenue_per_visit": _VISIT,
    "k07_churn_by_state_insurance": f"""SELECT state, insurance_type, {n()} AS patients,
        sum(churn_flag)::BIGINT AS churned, {pct('sum(churn_flag)', n())} AS churn_rate_pct,
        {rnd(avg('total_billed'))} AS avg_lifetime_billed FROM patients GROUP BY state, insurance_type""",
    "k07b_churn_by_state": _CHURN_STATE,
    "k08_claim_rejections": f"""SELECT month, claim_type, {n()} AS total_claims, {n(REJ)} AS rejected,
        {pct(n(REJ), n())} AS rejection_rate_pct, {total('rejected_amount')} AS rejected_value
        FROM claims GROUP BY month, claim_type""",
    "k08b_claim_refusals": f"""SELECT month, claim_type, {n()} AS total_claims,
        {n("claim_status IN ('rejected','partial')")} AS rejected_count,
        {pct(n("claim_status IN ('rejected','partial')"), n())} AS rejection_rate FROM claims GROUP BY month, claim_type""",
    "k08c_claim_rejection_chart": f"""SELECT month, claim_type, {pct(n(REJ), n())} AS rejection_rate,
        {total('rejected_amount', REJ)} AS rejected_value FROM claims GROUP BY month, claim_type""",
    "k08d_rejected_value_by_month": f"""SELECT month, {total('rejected_amount')} AS rejected_value
        FROM claims WHERE {REJ} GROUP BY month""",
    "k09_telehealth_trend": f"""SELECT month, {n()} AS total_appointments, {n(TELE)} AS telehealth_count,
        {pct(n(TELE), n())} AS telehealth_pct, {total('billed_amount', TELE)} AS telehealth_revenue
        FROM appointments WHERE {DONE} GROUP BY month""",
    "k09b_telehealth_by_keyword": f"""SELECT month, {n()} AS total, {n(TELE)} AS telehealth,
        {total('billed_amount', TELE)} AS tele_rev, {total('billed_amount', f'NOT {TELE}')} AS inperson_rev,
        {pct(n(TELE), n())} AS tele_rate FROM appointments GROUP BY month""",
    "k09c_telehealth_billing": f"""SELECT CASE WHEN {TELE} THEN 'Telehealth' ELSE 'In-Person' END AS visit_kind,
        {rnd(avg('billed_amount'))} AS avg_billed FROM appointments WHERE {DONE} GROUP BY 1""",
    "k09d_telehealth_growth": f"""WITH m AS (SELECT month, {raw_pct(n(TELE), n())} AS r FROM appointments GROUP BY month),
        o AS (SELECT r, row_number() OVER (ORDER BY month) i, row_number() OVER (ORDER BY month DESC) j FROM m),
        e AS (SELECT count(*) AS months,
          ((SELECT r FROM o WHERE i=1)+(SELECT r FROM o WHERE i=2)+(SELECT r FROM o WHERE i=3))/3e0 AS a,
          ((SELECT r FROM o WHERE j=1)+(SELECT r FROM o WHERE j=2)+(SELECT r FROM o WHERE j=3))/3e0 AS b FROM m)
        SELECT months, CASE WHEN months>=6 THEN {rnd('a')} END AS early_rate,
        CASE WHEN months>=6 THEN {rnd('b')} END AS late_rate,
        CASE WHEN months>=6 THEN {rnd('((b-a)/(a+1e-9)*100)')} ELSE 0e0 END AS growth_pct FROM e""",
    "k10_out_of_pocket": f"""SELECT month, {rnd(avg('patient_gap', 'patient_gap > 0'))} AS avg_gap_payment,
        CAST(round(sum(patient_gap),2) AS DOUBLE) AS total_gap_collected,
        {total('billed_amount-medicare_rebate-insurance_paid-coalesce(patient_gap,0)')} AS uncollected
        FROM appointments WHERE {DONE} GROUP BY month""",
    "k11_staff_utilisation": f"""SELECT s.clinic_name, s.state, s.clinic_type, count(a.appointment_id) AS total_appointments,
        count(DISTINCT a.patient_id) AS unique_patients, {rnd(avg('a.billed_amount'))} AS avg_billed_per_appt,
        CAST(round(sum(a.billed_amount),2) AS DOUBLE) AS total_revenue,
        {rnd("(CAST(sum(CAST(round(s.avg_patient_rating*10) AS BIGINT)) AS DOUBLE)/count(*)/10e0)")} AS avg_staff_rating
        FROM staff s LEFT JOIN appointments a ON a.staff_id=s.staff_id AND a.{DONE}
        GROUP BY s.clinic_name, s.state, s.clinic_type""",
    "k12_referral_quality": f"""SELECT referral_source, count(DISTINCT patient_id) AS patients,
        {rnd(avg('total_appointments'))} AS avg_appointments, {rnd(avg('total_billed'))} AS avg_lifetime_value,
        sum(churn_flag)::BIGINT AS churned, {pct('sum(churn_flag)', n())} AS churn_rate_pct
        FROM patients GROUP BY referral_source""",
    "k13_executive_summary": f"""WITH a AS (SELECT {n()} AS total_appointments, {n(DONE)} AS completed_appointments,
          {total('billed_amount', DONE)} AS total_revenue, {rnd(avg('billed_amount', DONE))} AS avg_billed,
          {rnd(avg('wait_days'), 1)} AS avg_wait_days, {pct(n(MISS), n(), 1)} AS no_show_rate_pct,
          {pct(n(BULK), n(), 1)} AS bulk_billing_rate_pct FROM appointments),
        p AS (SELECT {pct('sum(churn_flag)', n(), 1)} AS churn_rate_pct,
          {n("medicare_number LIKE '%INVALID-%'")} AS invalid_ids FROM patients),
        s AS (SELECT {rnd(avg('overall_score'))} AS avg_satisfaction FROM surveys),
        c AS (SELECT state AS highest_churn_state, churn_rate AS highest_churn_state_value FROM ({_CHURN_STATE})
          ORDER BY churn_rate DESC, state LIMIT 1),
        w AS (SELECT specialty AS longest_wait_specialty, avg_wait AS longest_wait_specialty_value FROM ({_WAIT_ALL})
          ORDER BY avg_wait DESC, specialty LIMIT 1),
        g AS (SELECT specialty AS highest_margin_specialty, margin_pct AS highest_margin_specialty_value
          FROM ({_VISIT}) WHERE margin_pct IS NOT NULL ORDER BY margin_pct DESC, specialty LIMIT 1)
        SELECT * FROM a, p, s, c, w, g""",
    "k14_month_number": f"""SELECT CAST(appointment_date AS VARCHAR) AS appointment_date, count(*) AS count,
        CAST({MONTH_NUM} AS INTEGER) AS month_num FROM appointments GROUP BY appointment_date""",
    "v01_monthly_revenue": f"""SELECT month, billing_type, {n(DONE)} AS completed_appointments,
        {total('billed_amount', DONE)} AS total_revenue_aud, {rnd(avg('billed_amount', DONE))} AS avg_billed_aud,
        {pct(n(MISS), n())} AS no_show_rate_pct FROM appointments GROUP BY month, billing_type""",
    "v03_billing_leakage": f"""SELECT month, claim_type, {n()} AS total_claims, {n(REJ)} AS rejected_claims,
        {total('rejected_amount', REJ)} AS rejected_value_aud, {pct(n(REJ), n())} AS rejection_rate_pct
        FROM claims GROUP BY month, claim_type""",
    "v06_monthly_revenue_by_type": f"""SELECT month, billing_type, {n(DONE)} AS completed_appointments,
        {total('billed_amount', DONE)} AS total_revenue_aud, {rnd(avg('billed_amount', DONE))} AS avg_billed_aud
        FROM appointments GROUP BY month, billing_type""",
}

KPI = {name: oracle(body) for name, body in KPI_BODIES.items()}
