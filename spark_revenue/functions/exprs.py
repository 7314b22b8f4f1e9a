"""Small column expressions used throughout.

Money stays DECIMAL until an average or a ratio is taken.  Averages are an exact decimal sum
divided by a count, and every rounded double uses one half-away-from-zero rule, so results do
not depend on the order in which partitions were added up.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

COMPLETED = "completed"
NO_SHOW = "no_show"


def has_status(*names: str, column: str = "status") -> Column:
    return F.col(column).isin(*names) if len(names) > 1 else F.col(column) == names[0]


def done() -> Column:
    return has_status(COMPLETED)


def missed() -> Column:
    return has_status(NO_SHOW)


def month_of(date: str | Column) -> Column:
    return F.trunc(date, "MM")


def in_months(df: DataFrame, first: Column | None, last: Column | None) -> DataFrame:
    """Only the ``month`` partitions between two dates, where the frame is a saved table that has them.

    Spark can't tell from a filter on the date which months hold it.
    """
    if dict(df.dtypes).get("month") != "date":
        return df
    if first is not None:
        df = df.filter(F.col("month") >= F.trunc(first, "MM"))
    return df if last is None else df.filter(F.col("month") <= F.trunc(last, "MM"))


def round_half_up(value: Column, digits: int = 2) -> Column:
    """Round a double half away from zero; NULL stays NULL."""
    scale = float(10**digits)
    value = value.cast("double")
    return F.signum(value) * F.floor(F.abs(value) * F.lit(scale) + F.lit(0.5)) / F.lit(scale) + F.lit(0.0)


def money(value: Column) -> Column:
    """Round a DECIMAL amount to cents without leaving DECIMAL."""
    return F.round(value, 2)


def ratio(num: Column, den: Column) -> Column:
    """Double division, NULL when the denominator is zero or NULL."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def pct(num: Column, den: Column) -> Column:
    return F.try_divide(F.lit(100.0) * num.cast("double"), den.cast("double"))


def rate_pct(num: Column, den: Column, digits: int = 2) -> Column:
    return round_half_up(pct(num, den), digits)


def sum_if(cond: Column, value: str | Column) -> Column:
    """Sum over matching rows, 0 when none match."""
    value = F.col(value) if isinstance(value, str) else value
    return F.coalesce(F.sum(F.when(cond, value)), F.lit(0))


def mean(value: str | Column) -> Column:
    """Average of the non-NULL values as exact sum over count."""
    return ratio(F.sum(value), F.count(value))


def mean_if(cond: Column, value: str | Column) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return mean(F.when(cond, value))


def is_complaint(column: str = "complaint_category") -> Column:
    """A category that is present; NULL and the text 'None' both mean no complaint."""
    return F.col(column).isNotNull() & (F.col(column) != "None")


def normalised(column: str | Column) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.lower(F.trim(column))


def all_of(*conditions: Column) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def with_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row frame (an ungrouped aggregate) to every row of ``df``.

    Planned as a scalar subquery: it runs once and its value is a literal in the main job, so
    there is neither a join nor a broadcast.
    """
    packed = one_row.select(F.struct(*one_row.columns).alias("v")).scalar()
    return df.select("*", packed.alias("__scalars")).select(
        *[F.col(c) for c in df.columns],
        *[F.col(f"__scalars.{c}").alias(c) for c in one_row.columns],
    )


def as_rows(one_row: DataFrame, names: list[str], rows: list[list[Column]]) -> DataFrame:
    """Turn a one-row frame into ``len(rows)`` rows of columns ``names``."""
    structs = [F.struct(*[c.alias(n) for c, n in zip(r, names)]) for r in rows]
    return one_row.select(F.inline(F.array(*structs)))


def top_value(df: DataFrame, keys: list[str], column: str, out: str) -> DataFrame:
    """Most frequent present value of ``column`` per key; ties go to the smallest value.

    Counts per (keys, value) first, so a hot key is combined map-side; 'None' and NULL are not values.
    """
    counted = df.filter(is_complaint(column)).groupBy(*keys, column).agg(F.count("*").alias("__n"))
    best = F.min_by(F.col(column), F.struct((-F.col("__n")).alias("n"), F.col(column).alias("v")))
    return counted.groupBy(*keys).agg(best.alias(out))


def month_number(df: DataFrame, date: str = "appointment_date", out: str = "month_num",
                 dates: DataFrame | None = None) -> DataFrame:
    """Months since the first month in ``df``, starting at 1.

    ``dates`` is a narrow frame with the same dates; where ``df`` is a join, it spares running that twice.
    """
    first = (df if dates is None else dates).agg(F.min(F.trunc(date, "MM")).alias("__first_month"))
    months = F.months_between(F.trunc(date, "MM"), F.col("__first_month")).cast("int") + 1
    return with_scalars(df, first).withColumn(out, months).drop("__first_month")
