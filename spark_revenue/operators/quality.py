"""Data-quality audits and cleaning rules.

Audits are single aggregates; de-duplication is an aggregate too (never a window per key), so full
copies and hot keys are combined before the shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.exprs import normalised, rate_pct, with_scalars
from ..schema import BILLING_TYPES, CLAIM_STATUSES, CLAIM_TYPES, STATUSES

# Spellings (lower case, trimmed) and the category they stand for.
SPECIALTY_MAP = {
    "mh": "Mental Health",
    "mental health": "Mental Health",
    "mental_health": "Mental Health",
    "gp": "GP",
    "general practice": "GP",
    "cardiology": "Cardiology",
    "oncology": "Oncology",
    "orthopaedics": "Orthopaedics",
    "orthopaedic": "Orthopaedics",
    "ortho": "Orthopaedics",
    "paediatrics": "Paediatrics",
    "paediatric": "Paediatrics",
    "paeds": "Paediatrics",
    "emergency": "Emergency",
    "dermatology": "Dermatology",
    "derm": "Dermatology",
}
SPECIALTY_MAP_WIDE = {
    "mental health": "Mental Health",
    "mh": "Mental Health",
    "mental_health": "Mental Health",
    "mentalhealth": "Mental Health",
    "general practice": "General Practice",
    "gp": "General Practice",
    "general_practice": "General Practice",
    "cardiology": "Cardiology",
    "cardio": "Cardiology",
    "physiotherapy": "Physiotherapy",
    "physio": "Physiotherapy",
    "physical therapy": "Physiotherapy",
    "paediatrics": "Paediatrics",
    "pediatrics": "Paediatrics",
    "paeds": "Paediatrics",
    "peds": "Paediatrics",
}
TRACKED_APPOINTMENT_COLUMNS = ["patient_gap", "billed_amount", "medicare_rebate", "insurance_paid"]
TRACKED_SURVEY_COLUMNS = ["overall_score", "wait_time_rating", "doctor_rating", "facility_rating"]
INVALID_MARK = "INVALID-"
TEN_DIGITS = r"^\d{10}$"


# --- audits -----------------------------------------------------------------------------------

def null_audit(df: DataFrame, columns: list[str], total: str = "total_rows") -> DataFrame:
    """Row count and NULL count per column, one row."""
    return df.agg(
        F.count("*").alias(total), *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns]
    )


def survey_null_audit(surveys: DataFrame) -> DataFrame:
    """NULL scores with the overall share."""
    return null_audit(surveys, ["overall_score", "wait_time_rating", "doctor_rating"], "total_surveys").withColumn(
        "null_overall_pct", rate_pct(F.col("null_overall_score"), F.col("total_surveys"))
    )


def null_summary(datasets: dict[str, DataFrame]) -> DataFrame:
    """(dataset, column, null_count, null_pct) of every column that has NULLs."""

    def one(name: str, df: DataFrame) -> DataFrame:
        counts = null_audit(df, df.columns, "__rows")
        long = counts.select(
            F.col("__rows"),
            F.inline(F.array(*[
                F.struct(F.lit(c).alias("column"), F.col(f"null_{c}").alias("null_count")) for c in df.columns
            ])),
        )
        return long.filter("null_count > 0").select(
            F.lit(name).alias("dataset"), "column", "null_count",
            rate_pct(F.col("null_count"), F.col("__rows")).alias("null_pct"),
        )

    return reduce(DataFrame.unionByName, [one(n, d) for n, d in datasets.items()])


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("occurrences")).filter("occurrences > 1")


def duplicate_report(df: DataFrame) -> DataFrame:
    """Rows before, rows after and rows removed by full-row de-duplication."""
    copies = df.groupBy(*df.columns).agg(F.count("*").alias("__n"))
    return copies.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("rows_before"), F.count("*").alias("rows_after")
    ).withColumn("rows_removed", F.col("rows_before") - F.col("rows_after"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Frequency of each value."""
    return df.groupBy(column).agg(F.count("*").alias("row_count"))


def first_dates(appointments: DataFrame) -> DataFrame:
    """One visit date per appointment id (the earliest when ids repeat)."""
    return appointments.groupBy("appointment_id").agg(F.min("appointment_date").alias("appointment_date"))


def impossible_survey_dates(surveys: DataFrame, appointments: DataFrame) -> DataFrame:
    """C4: surveys dated before their visit."""
    return surveys.join(appointments, "appointment_id").filter("survey_date < appointment_date").select(
        "survey_id", "appointment_id", "appointment_date", "survey_date"
    )


def impossible_survey_count(surveys: DataFrame, appointments: DataFrame) -> DataFrame:
    """C4, count form, over one date per appointment id."""
    dated = surveys.join(first_dates(appointments), "appointment_id", "left")
    return dated.agg(F.count_if(F.col("survey_date") < F.col("appointment_date")).alias("impossible_dates"))


def valid_identifier(column: str = "medicare_number", rule: str = "mark", strip_spaces: bool = False) -> Column:
    """The two identifier rules: ten bare digits, or not carrying the invalid mark."""
    value = F.regexp_replace(column, r"\s", "") if strip_spaces else F.col(column)
    if rule == "digits":
        return value.rlike(TEN_DIGITS)
    return ~F.coalesce(value.contains(INVALID_MARK), F.lit(False))


def invalid_identifiers(patients: DataFrame, rule: str = "digits", strip_spaces: bool = False) -> DataFrame:
    """C5 (digits) and C5b (mark): patients whose identifier breaks the rule."""
    return patients.filter(~valid_identifier(rule=rule, strip_spaces=strip_spaces)).select(
        "patient_id", "medicare_number"
    )


def negative_amounts(df: DataFrame, amounts: list[str], keep: list[str]) -> DataFrame:
    """Rows where any amount is below zero."""
    return df.filter(reduce(lambda a, b: a | b, [F.col(c) < 0 for c in amounts])).select(*keep, *amounts)


def impossible_ages(patients: DataFrame, top: int = 120) -> DataFrame:
    """C14: ages below 0 or above ``top``."""
    return patients.agg(F.count_if((F.col("age") < 0) | (F.col("age") > top)).alias("impossible_ages"))


def referential_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """Orphan rows per relationship and values outside each list."""
    patients, appointments = tables["patients"], tables["appointments"]
    links = [
        ("appointments.patient_id", appointments, "patient_id", patients),
        ("appointments.staff_id", appointments, "staff_id", tables["staff"]),
        ("satisfaction_surveys.patient_id", tables["satisfaction_surveys"], "patient_id", patients),
        ("satisfaction_surveys.appointment_id", tables["satisfaction_surveys"], "appointment_id", appointments),
        ("billing_claims.patient_id", tables["billing_claims"], "patient_id", patients),
        ("billing_claims.appointment_id", tables["billing_claims"], "appointment_id", appointments),
    ]
    lists = [
        ("appointments.status", appointments, "status", STATUSES),
        ("appointments.billing_type", appointments, "billing_type", BILLING_TYPES),
        ("billing_claims.claim_type", tables["billing_claims"], "claim_type", CLAIM_TYPES),
        ("billing_claims.claim_status", tables["billing_claims"], "claim_status", CLAIM_STATUSES),
    ]

    def count(name: str, bad: DataFrame) -> DataFrame:
        return bad.agg(F.count("*").alias("violations")).select(F.lit(name).alias("check"), "violations")

    parts = [
        count(f"orphan {name}", child.filter(F.col(key).isNotNull()).join(parent.select(key), key, "left_anti"))
        for name, child, key, parent in links
    ]
    parts += [count(f"unlisted {name}", df.filter(~F.col(col).isin(allowed))) for name, df, col, allowed in lists]
    return reduce(DataFrame.unionByName, parts)


# --- fixes ------------------------------------------------------------------------------------

def fill_gap(appointments: DataFrame) -> DataFrame:
    """A missing gap payment is no payment."""
    return appointments.withColumn("patient_gap", F.coalesce("patient_gap", F.lit(0)))


def first_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key, the first in the order of the remaining columns (NULLs first)."""
    rest = [c for c in df.columns if c not in keys]
    kept = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("__row"))
    return kept.select(*keys, "__row.*").select(*df.columns)


def drop_full_duplicates(df: DataFrame) -> DataFrame:
    """One of each set of identical rows."""
    return df.dropDuplicates()


def title_case(column: Column) -> Column:
    """Capitalise every letter that follows a non-letter; plain words take the cheap path."""
    low = F.lower(column)
    pieces = F.array_join(F.transform(F.split(low, "(?<=[^a-z])"), F.initcap), "")
    return F.when(low.rlike("^[a-z ]*$"), F.initcap(low)).otherwise(pieces)


def canonical(column: str, mapping: dict[str, str], unmatched: str = "title") -> Column:
    """Map a spelling to its category; others stay (``keep``) or become title case."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    other = F.col(column) if unmatched == "keep" else title_case(F.trim(column))
    return F.coalesce(F.element_at(F.create_map(*pairs), normalised(column)), other)


def canonicalise(df: DataFrame, column: str = "specialty", mapping: dict[str, str] | None = None,
                 unmatched: str = "title") -> DataFrame:
    return df.withColumn(column, canonical(column, mapping or SPECIALTY_MAP, unmatched))


def parse_date(column: str) -> Column:
    """ISO or day-first text to DATE, NULL when neither fits.

    The shape decides which reading applies, so no row pays for a failed parse.
    """
    text = F.col(column)
    day_first = F.concat_ws("-", F.substring(text, 7, 4), F.substring(text, 4, 2), F.substring(text, 1, 2))
    return (
        F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), text.try_cast("date"))
        .when(text.rlike(r"^\d{2}/\d{2}/\d{4}$"), day_first.try_cast("date"))
    )


def unparsed_dates(df: DataFrame, column: str) -> DataFrame:
    """How many texts did not parse."""
    parsed = parse_date(column)
    return df.agg(F.count("*").alias("total_rows"), F.count_if(parsed.isNull()).alias("unparsed"))


def repair_survey_dates(surveys: DataFrame, appointments: DataFrame, days: int = 1) -> DataFrame:
    """C11: a survey dated before its visit moves to ``days`` after it."""
    dates = first_dates(appointments).withColumnRenamed("appointment_date", "__visit")
    early = F.col("survey_date") < F.col("__visit")
    fixed = F.when(early, F.date_add("__visit", days)).otherwise(F.col("survey_date"))
    return surveys.join(dates, "appointment_id", "left").withColumn("survey_date", fixed).select(*surveys.columns)


def fill_medians(df: DataFrame, columns: list[str]) -> DataFrame:
    """NULL scores become the column's exact median (scores have few distinct values)."""
    medians = df.agg(*[F.median(c).alias(f"__median_{c}") for c in columns])
    filled = with_scalars(df, medians)
    return filled.select(*[
        F.coalesce(F.col(c).cast("double"), F.col(f"__median_{c}")).alias(c) if c in columns else F.col(c)
        for c in df.columns
    ])


def flag_identifiers(patients: DataFrame, rule: str = "mark", strip_spaces: bool = False) -> DataFrame:
    """Keep every row, add the boolean and the 0/1 flag."""
    valid = F.coalesce(valid_identifier(rule=rule, strip_spaces=strip_spaces), F.lit(True))
    return patients.withColumn("medicare_number_valid", valid).withColumn(
        "invalid_medicare_flag", F.when(F.col("medicare_number_valid"), 0).otherwise(1)
    )


def to_amount(column: str) -> Column:
    """Text to money; anything else is 0."""
    return F.coalesce(F.col(column).try_cast(T.DecimalType(18, 2)), F.lit(0).cast(T.DecimalType(18, 2)))


def clean_appointments(raw: DataFrame, mapping: dict[str, str] | None = None) -> DataFrame:
    """Date text to DATE, full copies out, category canonical, gap filled."""
    typed = raw.withColumn("appointment_date", parse_date("appointment_date"))
    return fill_gap(canonicalise(drop_full_duplicates(typed), mapping=mapping))


def clean_all(raw: dict[str, DataFrame], survey_days: int = 1) -> dict[str, DataFrame]:
    """C20: the whole cleaning order as one lazy plan per table."""
    appointments = clean_appointments(raw["appointments"])
    surveys = fill_medians(raw["satisfaction_surveys"], ["overall_score"])
    return {
        "patients": flag_identifiers(raw["patients"]),
        "staff": raw["staff"],
        "appointments": appointments,
        "satisfaction_surveys": repair_survey_dates(surveys, appointments, survey_days),
        "billing_claims": raw["billing_claims"],
    }


# --- reports over raw and clean ---------------------------------------------------------------

def validation_scorecard(patients: DataFrame, appointments: DataFrame, surveys: DataFrame) -> DataFrame:
    """Rows, missing values, negative values and impossible dates of three tables."""

    def card(name: str, df: DataFrame, nulls: Column, negative: Column, dates: Column) -> DataFrame:
        return df.agg(
            F.count("*").alias("total_rows"), F.count_if(nulls).alias("null_issues"),
            F.count_if(negative).alias("negative_values"), F.count_if(dates).alias("impossible_dates"),
        ).select(F.lit(name).alias("table_name"), "*")

    never = F.lit(False)
    dated = surveys.join(first_dates(appointments), "appointment_id", "left")
    flagged = patients if "medicare_number_valid" in patients.columns else flag_identifiers(patients)
    age = F.col("age")
    return (
        card("appointments", appointments, F.col("patient_gap").isNull(), F.col("billed_amount") < 0, never)
        .unionByName(card("satisfaction_surveys", dated, F.col("overall_score").isNull(), never,
                          F.col("survey_date") < F.col("appointment_date")))
        .unionByName(card("patients", flagged, ~F.col("medicare_number_valid"), never, (age < 0) | (age > 120)))
    )


def shape_comparison(raw: dict[str, DataFrame], clean: dict[str, DataFrame]) -> DataFrame:
    """Rows and columns before and after, per table."""

    def one(name: str) -> DataFrame:
        rows = with_scalars(raw[name].agg(F.count("*").alias("rows_raw")),
                            clean[name].agg(F.count("*").alias("rows_clean")))
        return rows.select(
            F.lit(name).alias("dataset"), "rows_raw", "rows_clean",
            F.lit(len(raw[name].columns)).alias("cols_raw"), F.lit(len(clean[name].columns)).alias("cols_clean"),
            (F.col("rows_raw") - F.col("rows_clean")).alias("rows_removed"),
            F.lit(len(clean[name].columns) - len(raw[name].columns)).alias("cols_added"),
        )

    return reduce(DataFrame.unionByName, [one(n) for n in raw])


def fix_summary(raw: dict[str, DataFrame], clean: dict[str, DataFrame]) -> DataFrame:
    """C17: one counter per cleaning rule, before and after."""

    def counters(appointments: DataFrame, surveys: DataFrame, parsed: Column) -> DataFrame:
        rows = appointments.agg(
            F.count("*").alias("rows"),
            F.count_if(F.col("patient_gap").isNull()).alias("gaps"),
            F.count_distinct("specialty").alias("spellings"),
            F.count_if(parsed.isNull()).alias("dates"),
        )
        dated = appointments.withColumn("appointment_date", parsed)
        scores = surveys.agg(F.count_if(F.col("overall_score").isNull()).alias("scores"))
        return with_scalars(with_scalars(rows, scores), impossible_survey_count(surveys, dated))

    before = counters(raw["appointments"], raw["satisfaction_surveys"],
                      F.try_to_date(F.col("appointment_date"), "yyyy-MM-dd"))
    after = counters(clean["appointments"], clean["satisfaction_surveys"], F.col("appointment_date"))
    ids = raw["patients"].agg(F.count_if(~valid_identifier()).alias("ids"))
    flags = clean["patients"].agg(F.sum("invalid_medicare_flag").alias("flags"))
    prefixed = after.select(*[F.col(c).alias(f"after_{c}") for c in after.columns])
    wide = with_scalars(with_scalars(with_scalars(before, prefixed), ids), flags)
    rules = [
        (1, "appointments", "NULL patient_gap", "gaps", "after_gaps"),
        (2, "appointments", "rows before and after removing full copies", "rows", "after_rows"),
        (3, "appointments", "specialty spellings", "spellings", "after_spellings"),
        (4, "surveys", "NULL overall_score", "scores", "after_scores"),
        (5, "surveys", "survey before its visit", "impossible_dates", "after_impossible_dates"),
        (6, "patients", "invalid identifiers found and flagged", "ids", "flags"),
        (7, "appointments", "dates not readable as ISO", "dates", "after_dates"),
    ]
    structs = [
        F.struct(F.lit(i).alias("fix"), F.lit(d).alias("dataset"), F.lit(t).alias("issue"),
                 F.col(b).alias("before"), F.col(a).alias("after"))
        for i, d, t, b, a in rules
    ]
    return wide.select(F.inline(F.array(*structs)))


def tracked_nulls(raw: dict[str, DataFrame], clean: dict[str, DataFrame]) -> DataFrame:
    """NULL counts of the tracked columns before and after."""
    tracked = {"appointments": TRACKED_APPOINTMENT_COLUMNS, "satisfaction_surveys": TRACKED_SURVEY_COLUMNS}

    def one(name: str, columns: list[str]) -> DataFrame:
        after = null_audit(clean[name], columns)
        after = after.select(*[F.col(f"null_{c}").alias(f"after_{c}") for c in columns])
        both = with_scalars(null_audit(raw[name], columns), after)
        return both.select(F.inline(F.array(*[
            F.struct(F.lit(name).alias("dataset"), F.lit(c).alias("column"),
                     F.col(f"null_{c}").alias("before"), F.col(f"after_{c}").alias("after"))
            for c in columns
        ])))

    return reduce(DataFrame.unionByName, [one(n, c) for n, c in tracked.items()])


def table_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows, columns and total NULLs per table, one aggregate each."""

    def one(name: str, df: DataFrame) -> DataFrame:
        nulls = sum((F.count_if(F.col(c).isNull()) for c in df.columns[1:]), F.count_if(F.col(df.columns[0]).isNull()))
        return df.agg(F.count("*").alias("rows"), nulls.alias("total_nulls")).select(
            F.lit(name).alias("dataset"), "rows", F.lit(len(df.columns)).alias("cols"), "total_nulls"
        )

    return reduce(DataFrame.unionByName, [one(n, d) for n, d in tables.items()])
