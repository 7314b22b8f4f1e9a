"""Feature table for the churn model: one wide numeric row per patient."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.exprs import has_status, is_complaint, mean, missed, ratio, round_half_up, with_scalars
from ..functions.ordered import exact_quantiles, ordered_measures
from .churn_rules import snapshot_row

# Fixed values.
MISSED_PATTERN = r"no.show|no show|dna|did not attend"
PROFILE = ["patient_id", "insurance_type", "state", "chronic_conditions", "churn_flag"]


def _activity(appointments: DataFrame, missed_flag: Column, remote_flag: Column) -> DataFrame:
    return appointments.groupBy("patient_id").agg(
        F.max("appointment_date").alias("last_visit"),
        F.count("appointment_id").alias("appointment_count"),
        F.sum("billed_amount").alias("total_billed"),
        mean("billed_amount").alias("avg_billed"),
        mean("wait_days").alias("avg_wait_days"),
        F.count_if(missed_flag).alias("no_show_count"),
        F.count_if(remote_flag).alias("telehealth_count"),
    )


def _opinion(surveys: DataFrame) -> DataFrame:
    return surveys.groupBy("patient_id").agg(
        mean("overall_score").alias("avg_overall_score"),
        mean("wait_time_rating").alias("avg_wait_rating"),
        F.count_if(is_complaint()).alias("complaint_count"),
    )


def build_features(patients: DataFrame, appointments: DataFrame, surveys: DataFrame | None = None,
                   snapshot: str | DataFrame | None = None, unseen_days: int = 999) -> DataFrame:
    """visit and survey features per patient, every gap filled; categories still as text.

    Rates and averages keep six decimals.
    """
    remote = has_status("telehealth", column="appointment_type")
    rows = patients.select(*PROFILE).join(_activity(appointments, missed(), remote), "patient_id", "left")
    if surveys is not None:
        rows = rows.join(_opinion(surveys), "patient_id", "left")
    else:
        empty = {"avg_overall_score": "double", "avg_wait_rating": "double", "complaint_count": "long"}
        rows = rows.withColumns({c: F.lit(None).cast(t) for c, t in empty.items()})
    count = F.col("appointment_count")

    def filled(column: Column | str, default: float | int) -> Column:
        column = F.col(column) if isinstance(column, str) else column
        return F.coalesce(column, F.lit(default))

    def rounded(column: Column | str, default: float) -> Column:
        column = F.col(column) if isinstance(column, str) else column
        return filled(round_half_up(column, 6), default)

    return with_scalars(rows, snapshot_row(appointments, snapshot)).select(
        *PROFILE,
        filled("appointment_count", 0).alias("appointment_count"),
        filled("total_billed", 0).alias("total_billed"),
        rounded("avg_billed", 0.0).alias("avg_billed"),
        rounded("avg_wait_days", 0.0).alias("avg_wait_days"),
        filled("no_show_count", 0).alias("no_show_count"),
        filled("telehealth_count", 0).alias("telehealth_count"),
        filled(F.datediff("__snapshot", "last_visit"), unseen_days).alias("days_since_visit"),
        rounded(ratio(F.col("no_show_count"), count), 0.0).alias("no_show_rate"),
        rounded(ratio(F.col("telehealth_count"), count), 0.0).alias("telehealth_rate"),
        rounded("avg_overall_score", 5.0).alias("avg_overall_score"),
        rounded("avg_wait_rating", 3.0).alias("avg_wait_rating"),
        filled("complaint_count", 0).alias("complaint_count"),
    )


def build_features_wide(patients: DataFrame, appointments: DataFrame, surveys: DataFrame,
                        snapshot: str | DataFrame | None = None) -> DataFrame:
    """The variant with age and lifetime billing, statuses matched by pattern, unseen recency 0
    and missing scores filled with the median patient."""
    missed_flag = F.coalesce(F.lower("status"), F.lit("")).rlike(MISSED_PATTERN)
    remote_flag = F.coalesce(F.lower("appointment_type"), F.lit("")).contains("telehealth")
    activity = _activity(appointments, missed_flag, remote_flag).drop("total_billed")
    people = patients.select(*PROFILE, "age", "total_billed")
    opinion = _opinion(surveys)
    rows = people.join(activity, "patient_id", "left").join(opinion, "patient_id", "left")
    rows = with_scalars(rows, snapshot_row(appointments, snapshot))
    for column in ("avg_overall_score", "avg_wait_rating"):
        rows = with_scalars(rows, exact_quantiles(opinion, column, {f"__median_{column}": 0.5}))
    count = F.col("appointment_count")

    def zero(column: Column) -> Column:
        return F.coalesce(column, F.lit(0))

    def rounded(column: Column) -> Column:
        return F.coalesce(round_half_up(column, 6), F.lit(0.0))

    def or_median(column: str) -> Column:
        return rounded(F.coalesce(F.col(column), F.col(f"__median_{column}"))).alias(column)

    return rows.select(
        *PROFILE, "age", "total_billed", zero(count).alias("appointment_count"),
        rounded(F.col("avg_billed")).alias("avg_billed"), rounded(F.col("avg_wait_days")).alias("avg_wait_days"),
        rounded(ratio(F.col("telehealth_count"), count)).alias("telehealth_rate"),
        rounded(ratio(F.col("no_show_count"), count)).alias("no_show_rate"),
        zero(F.datediff("__snapshot", "last_visit")).alias("days_since_visit"),
        or_median("avg_overall_score"), or_median("avg_wait_rating"),
        zero(F.col("complaint_count")).alias("complaint_count"),
    )


def slug(text: Column) -> Column:
    """Lower case, every run of other characters an underscore, none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def vocabulary(df: DataFrame, column: str, limit: int | None = None) -> list[str]:
    """Distinct values of a category column in order, for results with a named column per value.

    With ``limit`` it refuses a column that is not a category.  Models take ``coded_matrix`` instead, which
    has any number of values.
    """
    found = df.select(column).filter(F.col(column).isNotNull()).distinct()
    names = [r[0] for r in (found if limit is None else found.limit(limit + 1)).collect()]
    if limit is not None and len(names) > limit:
        raise ValueError(f"{column} has more than {limit} distinct values")
    return sorted(names)


def one_hot(df: DataFrame, columns: dict[str, str], drop_first: bool = False,
            values: dict[str, list[str]] | None = None) -> DataFrame:
    """a 0/1 column per value (``prefix_value``); NULL is all zeros. ``columns`` maps column to prefix."""
    out = []
    for column, prefix in columns.items():
        known = (values or {}).get(column) or vocabulary(df, column)
        for value in known[1:] if drop_first else known:
            hit = F.coalesce(F.col(column) == value, F.lit(False)).cast("int")
            out.append(hit.alias(f"{prefix}_{value}"))
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, *out)


def condition_list(column: str) -> Column:
    """Listed conditions: split at ; or , and trimmed; NULL lists none."""
    return F.filter(F.transform(F.split(F.coalesce(column, F.lit("")), "[;,]"), lambda p: F.trim(p)), lambda p: p != "")


def category_tokens(categories: dict[str, str], lists: dict[str, str]) -> Column:
    """All categories of a row as sorted texts ``prefix_value``; NULL adds none.

    ``categories`` maps columns of one value to prefixes, ``lists`` columns of several.
    """
    def listed(column: str, prefix: str) -> Column:
        return F.transform(condition_list(column), lambda v: F.concat(F.lit(f"{prefix}_"), v))

    single = F.array_compact(F.array(*[F.concat(F.lit(f"{p}_"), F.col(c)) for c, p in categories.items()]))
    several = [listed(c, p) for c, p in lists.items()]
    return F.array_sort(F.array_distinct(F.concat(single.cast("array<string>"), *several)))


def fit_dictionary(rows: DataFrame, tokens: str = "categories") -> DataFrame:
    """``(value, index, rows)`` of all category values in order, from 0, however many there are."""
    counted = rows.select(F.explode(tokens).alias("value")).groupBy("value").agg(F.count("*").alias("rows"))
    numbered = ordered_measures(counted, [], "value", "value", row_number="__n")
    return numbered.select("value", (F.col("__n") - 1).cast("long").alias("index"), "rows")


def encode(rows: DataFrame, dictionary: DataFrame, key: str = "patient_id", tokens: str = "categories") -> DataFrame:
    """F2 and F3 as a sparse vector per row: ``(key, size, indices, values)``; unknown values are left out."""
    listed = rows.select(key, F.explode(tokens).alias("value")).join(dictionary.select("value", "index"), "value")
    coded = listed.groupBy(key).agg(F.sort_array(F.collect_set("index")).alias("__found"))
    nothing = F.array().cast("array<long>")
    filled = rows.select(key).join(coded, key, "left").withColumn("indices", F.coalesce("__found", nothing))
    return with_scalars(filled, dictionary.agg(F.count("*").alias("size"))).select(
        key, "size", "indices", F.transform("indices", lambda _: F.lit(1.0)).alias("values")
    )


def condition_flags(patients: DataFrame, column: str = "chronic_conditions", key: str = "patient_id",
                    names: list[str] | None = None) -> DataFrame:
    """one 0/1 column per listed condition (``chronic_<slug>``), text split at ; or ,."""
    parts = F.filter(F.transform(F.split(F.coalesce(column, F.lit("None")), "[;,]"), lambda p: F.trim(p)), lambda p: p != "")
    slugs = F.transform(parts, lambda p: F.concat(F.lit("chronic_"), slug(p)))
    names = names or vocabulary(patients.select(F.explode(slugs).alias("__name")), "__name")
    listed = patients.select(key, slugs.alias("__slugs"))
    return listed.select(key, *[F.array_contains("__slugs", n).cast("int").alias(n) for n in names])


CATEGORIES = {"insurance_type": "insurance_type", "state": "state"}
CONDITIONS = {"chronic_conditions": "chronic_conditions"}


def model_matrix(features: DataFrame, categories: dict[str, str] | None = None,
                 values: dict[str, list[str]] | None = None) -> DataFrame:
    """F1 with F2: a numeric table with a named column per category value."""
    categories = categories or {c: c for c in ("insurance_type", "state", "chronic_conditions")}
    return one_hot(features, categories, values=values)


def coded_matrix(features: DataFrame, categories: dict[str, str] | None = None,
                 lists: dict[str, str] | None = None) -> DataFrame:
    """F1 with F2 for any number of values: numbers as columns, categories as one array of texts."""
    categories, lists = categories or CATEGORIES, lists or CONDITIONS
    kept = [c for c in features.columns if c not in (*categories, *lists)]
    return features.select(*kept, category_tokens(categories, lists).alias("categories"))


def long_features(matrix: DataFrame, numbers: list[str], key: str = "patient_id", tokens: str = "categories") -> DataFrame:
    """``(key, feature, value)``: all numbers of a coded matrix, and 1 for each category of a row."""
    cells = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in numbers]
    own = F.transform(tokens, lambda t: F.struct(t.alias("feature"), F.lit(1.0).alias("value")))
    return matrix.select(key, F.inline(F.concat(F.array(*cells), own)))
