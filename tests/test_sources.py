import json

from fixtures import d, rows

from spark_revenue.operators import marts
from spark_revenue.operators.quality import clean_all
from spark_revenue.schema import TABLES
from spark_revenue.sources import readers, writers
from spark_revenue.sources.binding import DomainTables

FOLDER = "/root/testdata/sf0.001"

PATIENTS_CSV = """\
patient_id,full_name,gender,age,age_group,date_of_birth,state,city,postcode,medicare_number,insurance_type,health_fund,\
chronic_conditions,referral_source,registration_date,last_visit_date,churn_flag,total_appointments,total_billed
1,Ann,Female,40,35-54,1984-01-31,NSW,Sydney,2000,1234 56789 1,bulk_bill,None,,GP,2020-01-01,31/12/2024,0,3,120.50
two,Bob,Male,41,35-54,bad,VIC,Melbourne,3000,INVALID-1,self_pay,None,Asthma,GP,2020-01-01,2024-05-01,1,1,10.00
"""


def test_csv_keeps_none_text_and_corrupt_lines(spark, tmp_path):
    (tmp_path / "patients.csv").write_text(PATIENTS_CSV)
    raw = readers.read_raw_csv(spark, str(tmp_path), "patients").collect()
    assert raw[0].health_fund == "None" and raw[0].chronic_conditions is None
    assert raw[0]._corrupt_record is None and raw[1]._corrupt_record.startswith("two,Bob")
    clean = readers.read_clean_csv(spark, str(tmp_path), "patients")
    assert clean.columns == [f.name for f in TABLES["patients"].fields]
    first = clean.collect()[0]
    assert (first.date_of_birth, first.last_visit_date, str(first.total_billed)) == (d("1984-01-31"), d("2024-12-31"), "120.50")
    assert clean.collect()[1].date_of_birth is None


def test_fallback_order(spark, tmp_path):
    assert readers.load_table(spark, "staff", str(tmp_path)).count() == 0
    assert readers.load_table(spark, "staff").columns == [f.name for f in TABLES["staff"].fields]
    (tmp_path / "patients.csv").write_text(PATIENTS_CSV)
    assert readers.load_table(spark, "patients", str(tmp_path)).count() == 2
    spark.range(3).createOrReplaceTempView("patients")
    assert readers.load_table(spark, "patients", str(tmp_path)).count() == 3
    spark.catalog.dropTempView("patients")


def test_catalog_round_trip_is_partitioned_by_month(spark):
    t = DomainTables(spark, FOLDER)
    spark.sql("CREATE DATABASE IF NOT EXISTS round_trip")
    tables = {"billing_claims": t.claims(), "patients": t.patients()}
    assert writers.save_tables(tables, "round_trip") == ["round_trip.patients", "round_trip.billing_claims"]
    writers.save_tables(tables, "round_trip")
    back = spark.table("round_trip.billing_claims")
    assert back.count() == t.claims().count()
    plan = back.filter("month = DATE'1997-07-01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan
    spark.sql("DROP DATABASE round_trip CASCADE")


def test_month_reports_prune_saved_tables(spark):
    from spark_revenue.operators.dashboard import filter_slice
    from spark_revenue.operators.leakage import leakage_report

    t = DomainTables(spark, FOLDER)
    spark.sql("CREATE DATABASE IF NOT EXISTS by_month")
    tables = {"billing_claims": t.claims(), "appointments": t.appointments()}
    writers.save_tables(tables, "by_month")
    claims, visits = spark.table("by_month.billing_claims"), spark.table("by_month.appointments")
    report, wanted = leakage_report(claims, "1997-07-15"), leakage_report(t.claims(), "1997-07-15")
    part = filter_slice(visits, start="1997-01-10", end="1998-02-03")
    for df, scans in ((report, 2), (part, 1)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("PartitionFilters: [isnotnull(month") == scans, plan
    assert rows(report) == rows(wanted)
    assert part.count() == filter_slice(t.appointments(), start="1997-01-10", end="1998-02-03").count() > 0
    spark.sql("DROP DATABASE by_month CASCADE")


def test_export_and_reload_check(spark, tmp_path):
    t = DomainTables(spark, FOLDER)
    raw = {**t.all(), "appointments": t.appointments_raw()}
    clean = {k: v for k, v in clean_all(raw).items() if k in ("patients", "satisfaction_surveys")}
    writers.export_tables(clean, str(tmp_path))
    check = {r[0]: r for r in rows(writers.reload_check(spark, str(tmp_path), list(clean)), "dataset", "rows", "cols")}
    assert check["patients"] == ("patients", t.patients().count(), 21)
    assert check["satisfaction_surveys"][1] == t.surveys().count()
    text = spark.read.option("header", True).csv(str(tmp_path / "patients.csv"))
    assert text.columns == clean["patients"].columns


def test_marts_and_recommendation_files(spark, tmp_path):
    from spark_revenue.operators.recommend import COLUMNS
    from spark_revenue.plans.catalog import run

    recs = run(spark, FOLDER, "e06_recommendations")
    writers.write_marts({"recs": recs}, str(tmp_path))
    assert spark.read.parquet(str(tmp_path / "recs.parquet")).count() == recs.count()
    writers.write_recommendations(recs, str(tmp_path))
    csv = spark.read.option("header", True).csv(str(tmp_path / "recommendations.csv"))
    assert csv.columns == COLUMNS and csv.count() == recs.count()
    part = next((tmp_path / "recommendations.json").glob("part-*.json"))
    first = json.loads(part.read_text().splitlines()[0])
    assert first["rec_id"] == "REC-01" and set(first) == set(COLUMNS)


def test_views(spark):
    t = DomainTables(spark, FOLDER)
    marts.register_views({"vw_claims": t.claims()})
    assert spark.sql("SELECT count(*) FROM vw_claims").first()[0] == t.claims().count()
    assert rows(marts.refresh_summaries({"vw_claims": t.claims()})) == [("vw_claims", t.claims().count())]
    spark.catalog.dropTempView("vw_claims")


def test_ids_beyond_32_bits_and_lines_set_aside(spark, tmp_path):
    big = PATIENTS_CSV.replace("\n1,Ann", "\n3000000000,Ann")
    (tmp_path / "patients.csv").write_text(big)
    fits, aside = readers.read_checked_csv(spark, str(tmp_path), "patients")
    assert [r.patient_id for r in fits.collect()] == [3_000_000_000]
    assert aside.count() == 1 and aside.first()[readers.CORRUPT].startswith("two,Bob")


def test_lines_round_trip_and_bad_ones_are_set_aside(spark):
    t = DomainTables(spark, FOLDER)
    people = t.patients()
    lines = readers.csv_lines(people, "patients")
    fits, bad = readers.parse_lines(lines, "patients")
    columns = [f.name for f in TABLES["patients"].fields]
    assert bad.count() == 0 and fits.columns == columns
    assert sorted(fits.collect(), key=str) == sorted(people.select(columns).collect(), key=str)
    made = spark.createDataFrame([('1,"Ann ""A"", Lee",Female,x,' + "," * 15,), ("2,Bob",), ("",), ('3,"Eve, O",Female' + "," * 16,)], "line string")
    fits, bad = readers.parse_lines(made, "patients")
    assert [(r.patient_id, r.full_name, r.age) for r in fits.collect()] == [(3, "Eve, O", None)]
    assert sorted(r.line for r in bad.collect()) == ['1,"Ann ""A"", Lee",Female,x,' + "," * 15, "2,Bob"]


def test_refresh_rewrites_changed_months_only(spark, tmp_path):
    import os

    def times(path):
        return {d: os.stat(path / d).st_mtime_ns for d in os.listdir(path) if d.startswith("month=")}

    path = tmp_path / "mart"
    rows_of = lambda n: [(f"1997-{i % 6 + 1:02d}-01", i, f"r{i}") for i in range(n)] + [(None, -1, "none")]
    frame = lambda r: spark.createDataFrame(r, "month string, x long, name string")
    first = rows_of(60)
    assert len(marts.refresh_by_month(frame(first), str(path))) == 7
    assert marts.refresh_by_month(frame(first[::-1]), str(path)) == []
    before = times(path)
    changed = [r if r[1] != 13 else (r[0], r[1], "other") for r in first]
    assert marts.refresh_by_month(frame(changed), str(path)) == ["1997-02-01"]
    after = times(path)
    assert {d for d in before if before[d] != after[d]} == {"month=1997-02-01"}
    gone = [r for r in changed if r[0] not in ("1997-03-01", None)]
    assert marts.refresh_by_month(frame(gone), str(path)) == ["1997-03-01", "None"]
    back = marts.read_marts(spark, {"mart": frame(gone)}, str(tmp_path))["mart"]
    assert sorted(map(tuple, back.select("month", "x", "name").collect())) == sorted(gone)
    assert [d for d in os.listdir(tmp_path) if d != "mart"] == []


def test_views_answer_through_the_catalog(spark):
    marts.register_views({"vw_a": spark.range(5), "vw_b": spark.range(0)})
    got = marts.views_of(spark, {"vw_a": "sum(id)", "vw_b": "sum(id)"}).collect()
    assert [tuple(r) for r in got] == [("vw_a", 5, 10.0), ("vw_b", 0, None)]
