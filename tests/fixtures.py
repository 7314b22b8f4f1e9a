"""Small hand-made tables."""

import datetime as dt

from pyspark.sql import functions as F


def d(text):
    return dt.date.fromisoformat(text)


APPT = (
    "appointment_id int, patient_id int, staff_id int, clinic_id int, appointment_date date, specialty string, "
    "appointment_type string, wait_days int, status string, billing_type string, scheduled_fee decimal(18,2), "
    "billed_amount decimal(18,2), medicare_rebate decimal(18,2), patient_gap decimal(18,2), "
    "insurance_paid decimal(18,2), staff_cost decimal(18,2)"
)


def appointments(spark, rows):
    """Rows given as dicts; missing columns take plain defaults."""
    base = {
        "appointment_id": 1, "patient_id": 1, "staff_id": 1, "clinic_id": 1, "appointment_date": d("2024-01-01"),
        "specialty": "GP", "appointment_type": "in_person", "wait_days": 5, "status": "completed",
        "billing_type": "bulk_bill", "scheduled_fee": 100, "billed_amount": 100, "medicare_rebate": 0,
        "patient_gap": 0, "insurance_paid": 0, "staff_cost": 20,
    }
    names = list(base)
    data = []
    for i, row in enumerate(rows):
        full = {**base, "appointment_id": i + 1, **row}
        data.append(tuple(str(full[n]) if n in MONEY and full[n] is not None else full[n] for n in names))
    text = ", ".join(f"{n} {'string' if n in MONEY else t}" for n, t in (c.strip().split(" ", 1) for c in split(APPT)))
    df = spark.createDataFrame(data, text)
    return df.select(*[F.col(n).cast("decimal(18,2)").alias(n) if n in MONEY else F.col(n) for n in names])


MONEY = {"scheduled_fee", "billed_amount", "medicare_rebate", "patient_gap", "insurance_paid", "staff_cost"}


def split(schema):
    out, depth, cur = [], 0, ""
    for ch in schema:
        depth += (ch == "(") - (ch == ")")
        if ch == "," and depth == 0:
            out.append(cur)
            cur = ""
        else:
            cur += ch
    return [*out, cur]


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)


# The churn fixture: 30 patients, three visits each, three surveys.
def churn_tables(spark):
    patients = spark.createDataFrame([
        (i, ["bulk_bill", "private_fund"][(i - 1) % 2], ["NSW", "VIC", "QLD", "SA", "WA"][(i - 1) % 5],
         ["Hypertension", None, "Diabetes", None, "Asthma"][(i - 1) % 5], (i - 1) % 2)
        for i in range(1, 31)
    ], "patient_id int, insurance_type string, state string, chronic_conditions string, churn_flag int")
    visits = appointments(spark, [
        {
            "appointment_id": p * 10 + i, "patient_id": p,
            "appointment_date": d("2025-01-01") + dt.timedelta(days=30 * i), "billed_amount": 100 + 10 * p,
            "wait_days": 5 + i, "status": "completed" if i < 2 else "no_show",
            "appointment_type": "in_person" if i < 2 else "telehealth",
        }
        for p in range(1, 31) for i in range(3)
    ])
    surveys = spark.createDataFrame(
        [(1, 8, 7, "None"), (2, 3, 2, "Wait Time"), (3, 6, 5, "None")],
        "patient_id int, overall_score int, wait_time_rating int, complaint_category string",
    )
    return patients, visits, surveys
