from fixtures import appointments, d, rows

from spark_revenue.operators import quality as q


def test_full_duplicates_and_same_id_other_amount(spark):
    df = appointments(spark, [
        {"appointment_id": 1, "billed_amount": 50}, {"appointment_id": 1, "billed_amount": 50},
        {"appointment_id": 1, "billed_amount": 70}, {"appointment_id": 2},
    ])
    assert rows(q.duplicate_report(df)) == [(4, 3, 1)]
    assert q.drop_full_duplicates(df).count() == 3
    kept = q.first_per_key(df, ["appointment_id"])
    assert kept.columns == df.columns
    assert [(r.appointment_id, int(r.billed_amount)) for r in kept.orderBy("appointment_id").collect()] == [(1, 50), (2, 100)]
    assert rows(q.duplicate_keys(df, ["appointment_id"])) == [(1, 3)]


def test_categories(spark):
    df = spark.createDataFrame(
        [(" MH ",), ("Mental_Health",), ("gp",), ("unknown thing",), ("o'neil clinic",), (None,)], "specialty string"
    )
    assert [r[0] for r in q.canonicalise(df).collect()] == [
        "Mental Health", "Mental Health", "GP", "Unknown Thing", "O'Neil Clinic", None]
    wide = q.canonicalise(df, mapping=q.SPECIALTY_MAP_WIDE, unmatched="keep")
    assert [r[0] for r in wide.collect()] == [
        "Mental Health", "Mental Health", "General Practice", "unknown thing", "o'neil clinic", None]


def test_dates(spark):
    df = spark.createDataFrame([("31/12/2024",), ("2024-12-31",), ("bad",), ("2024-02-30",), (None,)], "x string")
    got = [r[0] for r in df.select(q.parse_date("x")).collect()]
    assert got == [d("2024-12-31"), d("2024-12-31"), None, None, None]
    assert rows(q.unparsed_dates(df, "x")) == [(5, 3)]


def test_survey_dates_with_repeated_and_missing_visits(spark):
    visits = spark.createDataFrame(
        [(1, d("2024-05-10")), (1, d("2024-05-10")), (2, d("2024-05-10"))], "appointment_id int, appointment_date date")
    surveys = spark.createDataFrame(
        [(1, 1, d("2024-05-08")), (2, 2, d("2024-05-12")), (3, 99, d("2024-05-01"))],
        "survey_id int, appointment_id int, survey_date date")
    fixed = rows(q.repair_survey_dates(surveys, visits))
    assert fixed == [(1, 1, d("2024-05-11")), (2, 2, d("2024-05-12")), (3, 99, d("2024-05-01"))]
    assert rows(q.repair_survey_dates(surveys, visits, days=3))[0] == (1, 1, d("2024-05-13"))
    assert rows(q.impossible_survey_count(surveys, visits)) == [(1,)]
    assert rows(q.impossible_survey_count(q.repair_survey_dates(surveys, visits), visits)) == [(0,)]


def test_median_fill(spark):
    even = spark.createDataFrame([(1,), (2,), (None,), (9,)], "s int")
    assert sorted(r[0] for r in q.fill_medians(even, ["s"]).collect()) == [1.0, 2.0, 2.0, 9.0]
    odd = spark.createDataFrame([(1,), (2,), (None,), (9,), (10,)], "s int")
    assert 5.5 in [r[0] for r in q.fill_medians(odd, ["s"]).collect()]


def test_identifiers(spark):
    df = spark.createDataFrame(
        [(1, "1234567890"), (2, "1234 56789 1"), (3, "INVALID-123"), (4, None)], "patient_id int, medicare_number string")
    assert [r[0] for r in rows(q.invalid_identifiers(df, "digits"))] == [2, 3]
    assert [r[0] for r in rows(q.invalid_identifiers(df, "digits", strip_spaces=True))] == [3]
    flags = {r.patient_id: (r.medicare_number_valid, r.invalid_medicare_flag) for r in q.flag_identifiers(df).collect()}
    assert flags == {1: (True, 0), 2: (True, 0), 3: (False, 1), 4: (True, 0)}


def test_amounts_from_text(spark):
    df = spark.createDataFrame([("12.50",), ("n/a",), (None,)], "x string")
    assert [float(r[0]) for r in df.select(q.to_amount("x")).collect()] == [12.5, 0.0, 0.0]


def test_null_summary_keeps_only_columns_with_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (3, None)], "a int, b string")
    assert rows(q.null_summary({"t": df})) == [("t", "b", 2, 66.67)]


def test_ages(spark):
    df = spark.createDataFrame([(-1,), (0,), (120,), (121,)], "age int")
    assert rows(q.impossible_ages(df)) == [(2,)]
