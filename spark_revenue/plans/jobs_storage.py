"""Reading, writing and views as queries (ids S2, S8, P1)."""

import hashlib
import uuid

from pyspark.sql import DataFrame, functions as F

from ..operators import churn_rules as c
from ..operators import kpis as k
from ..operators import marts as m
from ..operators import scorecards as s
from ..schema import TABLES
from ..session import shared_folder, stored
from ..sources.binding import DomainTables
from ..sources.readers import csv_lines, parse_lines
from .jobs_analysis import _card_visits, _dates, _people, _views
from .registry import job

# Every 97th line has words for a number, every 101st breaks off.
WORDS, BROKEN = 97, 101


def _patient_lines(t: DomainTables) -> DataFrame:
    """All patients as lines of CSV, a third with day-first dates, some of them damaged."""
    people = t.patients()
    dates = [f.name for f in TABLES["patients"].fields if f.dataType.typeName() == "date"]
    day_first = {d: F.when(F.col("patient_id") % 3 == 0, F.date_format(d, "dd/MM/yyyy")).otherwise(F.col(d).cast("string")) for d in dates}
    texts = people.withColumns(day_first).withColumn(
        "age", F.when(F.col("patient_id") % WORDS == 0, F.lit("not known")).otherwise(F.col("age").cast("string")))
    lines = csv_lines(texts, "patients")
    number = F.substring_index("line", ",", 1).cast("long")
    return lines.select(F.when(number % BROKEN == 0, F.substring_index("line", ",", 7)).otherwise(F.col("line")).alias("line"))


def _set_aside(t: DomainTables) -> DataFrame:
    fits, bad = parse_lines(_patient_lines(t), "patients")
    counted = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("lines"), "n") for name, df in (("read", fits), ("set aside", bad))]
    return counted[0].union(counted[1])


def _all_views(t: DomainTables) -> dict[str, DataFrame]:
    # One join for all of them; the views read the tables as long as they are registered.
    visits, staff = stored(_card_visits(t)), stored(t.staff())
    return _views(t, visits, staff) | {
        "vw_monthly_revenue_by_type": k.revenue_by_type(visits, with_no_show=False),
        "vw_retention_priority": c.retention_priority_view(_people(t), visits, _dates(t)),
    }


TOTALS = {
    "vw_monthly_revenue": "sum(completed_appointments)", "vw_churn_risk": "sum(total_appointments)",
    "vw_billing_leakage": "sum(rejected_value_aud)", "vw_specialty_scorecard": "sum(completed_appointments)",
    "vw_clinic_performance": "sum(total_appointments)", "vw_monthly_revenue_by_type": "sum(total_revenue_aud)",
    "vw_retention_priority": "sum(days_inactive)",
}


def _asked_views(t: DomainTables) -> DataFrame:
    m.register_views(_all_views(t))
    return m.views_of(t.spark, TOTALS)


def _refreshed(t: DomainTables) -> DataFrame:
    folder = f"{shared_folder(t.spark)}/marts/{hashlib.sha256(t.path.encode()).hexdigest()[:16]}"
    shared = f"{shared_folder(t.spark)}/{uuid.uuid4().hex}"
    marts = _views(t, stored(_card_visits(t), f"{shared}/visits"), stored(t.staff(), f"{shared}/staff"))
    m.refresh_marts(marts, folder)
    m.drop(t.spark, shared)
    return m.refresh_summaries(m.read_marts(t.spark, marts, folder))


job("s02_csv_parse", lambda t: parse_lines(_patient_lines(t), "patients")[0])
job("s02b_lines_set_aside", _set_aside)
job("s08_views", _asked_views)
job("p01_refresh_summaries", _refreshed)
