"""The linear churn model as a table of coefficients: scores and attributions by joins, for any number of features.

A feature adds its coefficient times its scaled distance from the training mean to the log-odds.  Categories that a
row doesn't have stand at 0; what they add is the same for all such rows and enters through one scalar.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.exprs import round_half_up, with_scalars
from .features import long_features
from .model import CATEGORIES, TrainedModel, number_columns

# Sums are exact, so results don't depend on the order of rows.
_EXACT = "decimal(28,12)"


def coefficient_table(spark: SparkSession, trained: TrainedModel) -> DataFrame:
    """``(feature, mean, std, coefficient, base)``: one row per feature; ``base`` is the log-odds at the means."""
    if trained.kind != "logistic":
        raise ValueError("attributions are defined for the linear model; use feature_importance for trees")
    scaler, linear = trained.model.stages[-2], trained.model.stages[-1]
    rows = [(n, float(m), float(s), float(c)) for n, m, s, c in zip(trained.feature_names, scaler.mean, scaler.std, linear.coefficients)]
    centred = sum(c * m / s for _, m, s, c in rows if s) if not scaler.getWithMean() else 0.0
    base = float(linear.intercept) + centred
    return spark.createDataFrame([(*r, base) for r in rows], "feature string, mean double, std double, coefficient double, base double")


def _cells(matrix: DataFrame, key: str) -> DataFrame:
    if CATEGORIES in matrix.columns:
        return long_features(matrix, number_columns(matrix), key)
    cells = [F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").cast("double").alias("value")) for c in number_columns(matrix)]
    return matrix.select(key, F.inline(F.array(*cells)))


def _added(value: Column) -> Column:
    """What a feature of this value adds; a feature that never varies adds nothing."""
    return F.coalesce(F.try_divide((value - F.col("mean")) * F.col("coefficient"), F.col("std")), F.lit(0.0)).cast(_EXACT)


def _known(matrix: DataFrame, coefficients: DataFrame, key: str) -> DataFrame:
    """Cells with their coefficients; the table is as long as the model, which every executor holds anyway."""
    return _cells(matrix, key).join(F.broadcast(coefficients), "feature")


def log_odds(matrix: DataFrame, coefficients: DataFrame, key: str = "patient_id") -> DataFrame:
    """``(key, log_odds)`` of every row."""
    nothing = _added(F.lit(0.0))
    start = coefficients.agg((F.coalesce(F.max("base"), F.lit(0.0)).cast(_EXACT) + F.coalesce(F.sum(nothing), F.lit(0))).alias("__start"))
    sums = _known(matrix, coefficients, key).groupBy(key).agg(F.sum(_added(F.col("value")) - nothing).alias("__sum"))
    every = matrix.select(key).join(sums, key, "left")
    return with_scalars(every, start).select(key, (F.col("__start") + F.coalesce("__sum", F.lit(0))).cast("double").alias("log_odds"))


def linear_scores(matrix: DataFrame, coefficients: DataFrame, key: str = "patient_id") -> DataFrame:
    """``(key, churn_probability)``."""
    return log_odds(matrix, coefficients, key).select(key, (1 / (1 + F.exp(-F.col("log_odds")))).alias("churn_probability"))


def mean_attributions(matrix: DataFrame, coefficients: DataFrame, key: str = "patient_id", top: int = 15) -> DataFrame:
    """mean absolute contribution of each feature over all rows, largest first."""
    present = _known(matrix, coefficients, key).groupBy("feature").agg(
        F.sum(F.abs(_added(F.col("value")))).alias("__sum"), F.count("*").alias("__n")
    )
    every = with_scalars(coefficients.join(present, "feature", "left"), matrix.agg(F.count("*").alias("__rows")))
    absent = F.col("__rows") - F.coalesce("__n", F.lit(0))
    total = F.coalesce("__sum", F.lit(0)) + absent * F.abs(_added(F.lit(0.0)))
    mean = F.try_divide(total.cast("double"), F.col("__rows").cast("double"))
    table = every.select("feature", round_half_up(mean, 6).alias("mean_abs_contribution"))
    return table.orderBy(F.desc("mean_abs_contribution"), "feature").limit(top)


def explain_row(matrix: DataFrame, coefficients: DataFrame, scores: DataFrame, key: str = "patient_id") -> DataFrame:
    """contributions for the row at highest risk (ties by key), with the base value, largest first."""
    top = scores.agg(F.max_by(key, F.struct(F.col("churn_probability"), -F.col(key))).alias("__top"))
    one = with_scalars(matrix, top).filter(F.col(key) == F.col("__top")).drop("__top")
    own = _cells(one, key).select("feature", "value")
    rows = with_scalars(coefficients.join(own, "feature", "left"), top)
    return rows.select(
        F.col("__top").alias(key), "feature", round_half_up(_added(F.coalesce("value", F.lit(0.0))), 6).alias("contribution"),
        F.col("base").alias("base_value"),
    ).orderBy(F.desc(F.abs("contribution")), "feature")
