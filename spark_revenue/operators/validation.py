"""How good a classifier is: exact stratified folds, cross-validation, classification report."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.exprs import as_rows, ratio, round_half_up
from ..functions.ordered import ordered_measures
from ..session import materialise
from .model import boost, fit, number_columns, probabilities, ranking_quality, vectors, with_probability

ROWS_PER_PART = 250_000


def stratified_folds(df: DataFrame, folds: int = 5, label: str = "churn_flag", key: str = "patient_id",
                     seed: int = 42) -> DataFrame:
    """Add ``fold``. Each class is dealt over the folds in the order of the MD5 of seed and id, so fold sizes
    of a class differ by one at most, whatever the number of rows and wherever they lie."""
    hashed = df.withColumn("__h", F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")).cast("binary")))
    dealt = ordered_measures(hashed, [label], "__h", key, row_number="__n")
    return dealt.select(*df.columns, F.pmod(F.col("__n") - 1, F.lit(folds)).cast("int").alias("fold"))


def fold_sizes(folded: DataFrame, label: str = "churn_flag") -> DataFrame:
    """Rows of each class in each fold."""
    return folded.groupBy(label, "fold").agg(F.count("*").alias("rows"))


def boosting_parts(rows: int, cores: int, at_once: int) -> int:
    """In how many parts boosting reads its rows: a task of a pass takes far longer than its start, and the models
    trained side by side give every core two tasks."""
    return max(-(-rows // ROWS_PER_PART), -(-2 * cores // at_once))


def cross_validate(matrix: DataFrame, kind: str = "logistic", folds: int = 5, label: str = "churn_flag",
                   key: str = "patient_id", seed: int = 42, trees: int = 150, at_once: int = 5) -> DataFrame:
    """``(fold, roc_auc)``; one model per fold, fitted on the others, ``at_once`` of them at a time.

    Boosting reads one table of feature vectors for all folds.
    """
    spark, names = matrix.sparkSession, number_columns(matrix)
    folded = materialise(stratified_folds(matrix, folds, label, key, seed))
    ready = None
    if kind != "logistic":
        ready = vectors(folded, names, label, ("fold",), boosting_parts(folded.count(), spark.sparkContext.defaultParallelism, at_once))[1]

    def held_out(fold: int) -> tuple[int, float]:
        mine, others = F.col("fold") == fold, F.col("fold") != fold
        if ready is not None:
            scored = with_probability(boost(ready.filter(others), seed, trees).transform(ready.filter(mine)), "label")
            return fold, ranking_quality(scored, "label").first()["roc_auc"]
        model = fit(folded.filter(others).drop("fold"), names, kind, label, seed, trees)
        scored = probabilities(model, folded.filter(mine).drop("fold"), names)
        return fold, ranking_quality(scored, label).first()["roc_auc"]

    with ThreadPoolExecutor(at_once) as pool:
        found = list(pool.map(inheritable_thread_target(spark)(held_out), range(folds)))
    return spark.createDataFrame(found, "fold int, roc_auc double")


def cross_validation_summary(by_fold: DataFrame) -> DataFrame:
    """Mean and population deviation over the folds."""
    return by_fold.agg(
        round_half_up(F.avg("roc_auc"), 4).alias("cv_roc_auc_mean"), round_half_up(F.stddev_pop("roc_auc"), 4).alias("cv_roc_auc_std")
    )


def classification_report(scored: DataFrame, label: str = "label", predicted: str = "predicted") -> DataFrame:
    """Precision, recall, F1 and support of every class, then accuracy, macro and weighted means.

    Any number of classes: rows are counted per (label, predicted) first. A class that is never predicted has
    precision 0, one that never occurs has recall 0 and no support; rows without label or prediction are left out.
    """
    pairs = scored.filter(F.col(label).isNotNull() & F.col(predicted).isNotNull()).groupBy(
        F.col(label).cast("string").alias("__true"), F.col(predicted).cast("string").alias("__said")
    ).agg(F.count("*").alias("__n"))
    hit = F.when(F.col("__true") == F.col("__said"), F.col("__n")).otherwise(0)
    zero = F.lit(0).cast("long")
    roles = F.array(
        F.struct(F.col("__true").alias("class"), F.col("__n").alias("support"), zero.alias("said"), hit.alias("hits")),
        F.struct(F.col("__said").alias("class"), zero.alias("support"), F.col("__n").alias("said"), zero.alias("hits")),
    )
    counts = pairs.select(F.inline(roles)).groupBy("class").agg(*[F.sum(c).alias(c) for c in ("support", "said", "hits")])

    def or_zero(share: Column) -> Column:
        return F.coalesce(share, F.lit(0.0))

    hits = F.col("hits")
    classes = counts.select(
        "class", or_zero(ratio(hits, F.col("said"))).alias("precision"), or_zero(ratio(hits, F.col("support"))).alias("recall"),
        or_zero(ratio(2 * hits, F.col("said") + F.col("support"))).alias("f1"), "support", "hits",
    )
    measures = ["precision", "recall", "f1"]
    # Exact sums of rounded shares: a mean doesn't depend on the order of the classes.
    exact = {c: F.col(c).cast("decimal(20,12)") for c in measures}
    total = F.sum("support").alias("support")
    sums = classes.agg(
        total, F.sum("hits").alias("hits"), F.count("*").alias("classes"),
        *[F.sum(exact[c]).cast("double").alias(f"plain_{c}") for c in measures],
        *[F.sum(exact[c] * F.col("support")).cast("double").alias(f"weighted_{c}") for c in measures],
    )
    accuracy = ratio(F.col("hits"), F.col("support"))
    means = as_rows(sums, ["class", *measures, "support"], [
        [F.lit("accuracy"), accuracy, accuracy, accuracy, F.col("support")],
        [F.lit("macro avg"), *[F.try_divide(f"plain_{c}", "classes") for c in measures], F.col("support")],
        [F.lit("weighted avg"), *[F.try_divide(f"weighted_{c}", "support") for c in measures], F.col("support")],
    ])
    return classes.drop("hits").union(means.filter("support > 0")).select(
        "class", *[round_half_up(F.col(c), 4).alias(c) for c in measures], "support"
    )
