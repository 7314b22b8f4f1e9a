"""What drives the churn model: importances, mean attributions and one patient's explanation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .linear import coefficient_table, explain_row, mean_attributions
from .model import TrainedModel

# Prefixes of encoded columns and how they read.
LABELS = [("ins_", "Insurance: "), ("state_", "State: "), ("chronic_", "Chronic: ")]


def label_of(feature: Column) -> Column:
    """Readable name of an encoded column."""
    text = feature
    for prefix, words in LABELS:
        text = F.replace(text, F.lit(prefix), F.lit(words))
    return F.initcap(F.replace(text, F.lit("_"), F.lit(" ")))


def feature_importance(spark: SparkSession, trained: TrainedModel, top: int = 15) -> DataFrame:
    """tree importances, or the size of the scaled coefficients, largest first."""
    last = trained.model.stages[-1]
    values = last.featureImportances.toArray() if trained.kind != "logistic" else abs(last.coefficients.toArray())
    pairs = [(name, float(v)) for name, v in zip(trained.feature_names, values)]
    table = spark.createDataFrame(pairs, "feature string, importance double")
    return table.withColumn("label", label_of(F.col("feature"))).orderBy(F.desc("importance"), "feature").limit(top)


def mean_attribution(trained: TrainedModel, matrix: DataFrame, top: int = 15) -> DataFrame:
    """mean absolute contribution per feature, largest first."""
    return mean_attributions(matrix, coefficient_table(matrix.sparkSession, trained), top=top)


def explain_patient(trained: TrainedModel, matrix: DataFrame, scored: DataFrame) -> DataFrame:
    """contributions for the patient at highest risk, with the base value, largest first."""
    return explain_row(matrix, coefficient_table(matrix.sparkSession, trained), scored)
