"""Churn model with Spark ML: split, training, metrics, scoring, importances, revenue at risk."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.exprs import mean, money, rate_pct, ratio, round_half_up, with_scalars
from ..functions.ordered import ordered_measures
from ..session import materialise
from .features import fit_dictionary

NOT_FEATURES = ("patient_id", "churn_flag", "last_visit")
CATEGORIES = "categories"
BANDS = ["Low", "Medium", "High"]


@dataclass
class TrainedModel:
    model: PipelineModel
    kind: str
    feature_names: list[str]
    test: DataFrame
    metrics: dict[str, float]


def number_columns(matrix: DataFrame) -> list[str]:
    """Numeric features; all others are in the array of categories, if there is one."""
    other = {name for name, dtype in matrix.dtypes if dtype in ("string", "date") or dtype.startswith("array")}
    return [c for c in matrix.columns if c not in NOT_FEATURES and c not in other]


def names_of(model: PipelineModel) -> list[str]:
    """Names of a fitted pipeline's features, in the order of its vectors."""
    assembler = next(stage for stage in model.stages if isinstance(stage, VectorAssembler))
    vocabulary = [v for stage in model.stages if isinstance(stage, CountVectorizerModel) for v in stage.vocabulary]
    return [c for c in assembler.getInputCols() if c != "category_flags"] + vocabulary


def _bucket(key: str, seed: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(10_000))


def stratified_split(df: DataFrame, label: str = "churn_flag", key: str = "patient_id", test_size: float = 0.2,
                     seed: int = 42, exact: bool = False) -> DataFrame:
    """add ``is_test``. By hash of the id, so the share per class is approximate but the same for any
    partitioning; ``exact=True`` ranks the hashes within each class and takes exactly the share."""
    hashed = df.withColumn("__h", _bucket(key, seed))
    if not exact:
        return hashed.withColumn("is_test", F.col("__h") < int(test_size * 10_000)).drop("__h")
    ranked = ordered_measures(hashed, [label], "__h", key, row_number="__n")
    sizes = df.groupBy(label).agg(F.round(F.count("*") * test_size).alias("__take"))
    return ranked.join(sizes, label).withColumn("is_test", F.col("__n") <= F.col("__take")).select(
        *df.columns, "is_test"
    )


def _coding(names: list[str], values: list[str], to: str) -> list:
    """The stages that put numbers and flags of categories into one vector."""
    coder = []
    if values:
        # Sparse flags for any number of values; the model itself has as many coefficients.
        coder = [CountVectorizerModel.from_vocabulary(values, inputCol=CATEGORIES, outputCol="category_flags", minTF=1.0).setBinary(True)]
    return [*coder, VectorAssembler(inputCols=[*names, *["category_flags"] * bool(values)], outputCol=to)]


def _logistic(names: list[str], values: list[str], rows: float) -> list:
    # Centring would fill the sparse vectors; it moves the intercept alone, which carries no penalty.
    return [
        *_coding(names, values, "raw_features"),
        StandardScaler(inputCol="raw_features", outputCol="features", withMean=not values, withStd=True),
        LogisticRegression(
            labelCol="label", weightCol="weight", maxIter=1000, regParam=1.0 / rows, elasticNetParam=0.0,
            standardization=False,
        ),
    ]


def _known_values(rows: DataFrame) -> list[str]:
    """The category values of the rows in order, none without categories."""
    if CATEGORIES not in rows.columns:
        return []
    return [r["value"] for r in fit_dictionary(rows, CATEGORIES).orderBy("index").toLocalIterator()]


def _weighted(df: DataFrame, label: str) -> DataFrame:
    """Label as double and the balanced class weight n / (2 * n_class)."""
    counts = df.agg(F.count("*").alias("__n"), F.sum(label).alias("__pos"))
    own = F.when(F.col(label) == 1, F.col("__pos")).otherwise(F.col("__n") - F.col("__pos"))
    return with_scalars(df, counts).withColumn("weight", ratio(F.col("__n"), 2 * own)).withColumn(
        "label", F.col(label).cast("double")
    ).drop("__n", "__pos")


def vectors(rows: DataFrame, names: list[str], label: str = "churn_flag", kept: tuple[str, ...] = (),
            parts: int | None = None) -> tuple[PipelineModel, DataFrame]:
    """The coding of features, and a stored table of label, feature vector and the ``kept`` columns, in ``parts`` at most.

    Every task of a boosting pass is sent the plan of its rows, which is that of a stored table here.
    """
    coded = [CATEGORIES] if CATEGORIES in rows.columns else []
    coding = PipelineModel(stages=_coding(names, _known_values(rows), "features"))
    plain = rows.select(F.col(label).cast("double").alias("label"), *kept, *[F.col(f"`{c}`").cast("double") for c in names], *coded)
    coded_rows = coding.transform(plain).select("label", "features", *kept)
    return coding, materialise(coded_rows.coalesce(parts) if parts else coded_rows)


def boost(rows: DataFrame, seed: int = 42, trees: int = 150, subsample: float = 0.8) -> GBTClassificationModel:
    """The trees fitted on ``vectors``. A value that none of the rows has offers no split, so the table may know more values."""
    return GBTClassifier(
        labelCol="label", maxIter=trees, maxDepth=4, stepSize=0.05, subsamplingRate=subsample, seed=seed,
        checkpointInterval=10,
    ).fit(rows)


def fit(train: DataFrame, names: list[str], kind: str = "logistic", label: str = "churn_flag", seed: int = 42,
        trees: int = 150, subsample: float = 0.8) -> PipelineModel:
    """Fit one pipeline. The prepared rows are kept for the iterations."""
    if kind != "logistic":
        coding, ready = vectors(train, names, label)
        return PipelineModel(stages=[*coding.stages, boost(ready, seed, trees, subsample)])
    coded = [CATEGORIES] if CATEGORIES in train.columns else []
    prepared = _weighted(train, label).select("label", "weight", *[F.col(f"`{c}`").cast("double") for c in names], *coded)
    prepared = prepared.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rows = prepared.count()
        return Pipeline(stages=_logistic(names, _known_values(prepared), float(rows))).fit(prepared)
    finally:
        prepared.unpersist()


def with_probability(scored: DataFrame, *kept: str) -> DataFrame:
    """The ``kept`` columns of transformed rows and the churn probability."""
    return scored.select(*kept, vector_to_array("probability")[1].alias("churn_probability"))


def probabilities(model: PipelineModel, matrix: DataFrame, names: list[str]) -> DataFrame:
    """Rows with the churn probability of the fitted pipeline, numbers aligned by name."""
    vector_inputs = matrix.withColumns({f"__f_{i}": F.col(f"`{c}`").cast("double") for i, c in enumerate(names)})
    coded = [CATEGORIES] if CATEGORIES in matrix.columns else []
    renamed = vector_inputs.select(
        F.struct(*[f"`{c}`" for c in matrix.columns]).alias("__row"), *coded, *[F.col(f"__f_{i}").alias(c) for i, c in enumerate(names)]
    )
    scored = model.transform(renamed)
    return with_probability(scored, "__row.*")


def train_model(matrix: DataFrame, kind: str = "gbt", label: str = "churn_flag", key: str = "patient_id",
                test_size: float = 0.2, seed: int = 42, trees: int = 150, subsample: float = 0.8,
                exact_split: bool = False, kept: bool = False) -> TrainedModel:
    """split, fit and measure on the held-out rows; ``kept`` says that the matrix is a stored table already."""
    names = number_columns(matrix)
    matrix = matrix if kept else materialise(matrix)
    split = stratified_split(matrix, label, key, test_size, seed, exact_split)
    model = fit(split.filter("NOT is_test").drop("is_test"), names, kind, label, seed, trees, subsample)
    test = probabilities(model, split.filter("is_test").drop("is_test"), names)
    row = metrics(test, label).first()
    return TrainedModel(model, kind, names_of(model), test, {k: row[k] for k in row.asDict()})


# --- metrics ----------------------------------------------------------------------------------

def _thresholds(scored: DataFrame, label: str, score: str) -> DataFrame:
    """Per distinct score, highest first: rows and churners at or above it."""
    grouped = scored.groupBy(score).agg(F.count("*").alias("__n"), F.sum(F.col(label).cast("long")).alias("__pos"))
    ranked = ordered_measures(grouped, [], score, score, value_desc=True,
                              running={"__above": "__n", "__tp": "__pos"})
    totals = grouped.agg(F.sum("__n").alias("__all"), F.sum("__pos").alias("__all_pos"))
    return with_scalars(ranked, totals)


def roc_points(scored: DataFrame, label: str = "churn_flag", score: str = "churn_probability") -> DataFrame:
    """F5d: threshold, false-positive and true-positive rate for every distinct score."""
    fp = F.col("__above") - F.col("__tp")
    return _thresholds(scored, label, score).select(
        F.col(score).alias("threshold"),
        round_half_up(ratio(fp, F.col("__all") - F.col("__all_pos")), 6).alias("fpr"),
        round_half_up(ratio(F.col("__tp"), F.col("__all_pos")), 6).alias("tpr"),
    )


def ranking_quality(scored: DataFrame, label: str = "churn_flag", score: str = "churn_probability") -> DataFrame:
    """ROC-AUC (ties count half) and average precision (recall steps times precision), exact."""
    fp = F.col("__above") - F.col("__tp")
    neg_here = F.col("__n") - F.col("__pos")
    # Area under ROC: churners ranked above each non-churner, plus half of those tied with it.
    wins = F.sum(neg_here * (2 * F.col("__tp") - F.col("__pos")))
    step = F.col("__pos") * ratio(F.col("__tp"), F.col("__above"))
    table = _thresholds(scored, label, score)
    return table.agg(
        round_half_up(
            F.try_divide(wins.cast("double"), (2 * F.max("__all_pos") * (F.max("__all") - F.max("__all_pos"))).cast("double")), 4
        ).alias("roc_auc"),
        round_half_up(ratio(F.sum(step), F.max("__all_pos")), 4).alias("avg_precision"),
    )


def confusion(scored: DataFrame, label: str = "churn_flag", score: str = "churn_probability",
              cut: float = 0.5) -> DataFrame:
    """The four counts at the cut, and precision, recall, F1 and accuracy."""
    pos, hit = F.col(label) == 1, F.col(score) >= cut
    counts = scored.agg(
        F.count_if(pos & hit).alias("true_positive"), F.count_if(~pos & hit).alias("false_positive"),
        F.count_if(pos & ~hit).alias("false_negative"), F.count_if(~pos & ~hit).alias("true_negative"),
    )
    tp, fp, fn, tn = (F.col(c) for c in counts.columns)
    return counts.select(
        "*", round_half_up(ratio(tp, tp + fp), 4).alias("precision"), round_half_up(ratio(tp, tp + fn), 4).alias("recall"),
        round_half_up(ratio(2 * tp, 2 * tp + fp + fn), 4).alias("f1"),
        round_half_up(ratio(tp + tn, tp + fp + fn + tn), 4).alias("accuracy"),
    )


def metrics(scored: DataFrame, label: str = "churn_flag") -> DataFrame:
    """Ranking quality and confusion counts in one row."""
    return with_scalars(ranking_quality(scored, label), confusion(scored, label))


# --- scoring ----------------------------------------------------------------------------------

def risk_band(probability: Column, low_includes_edge: bool = False) -> Column:
    """Low under 0.30, High over 0.60; F6 with ``low_includes_edge`` puts 0.30 itself in Low."""
    low = probability <= 0.30 if low_includes_edge else probability < 0.30
    return F.when(low, "Low").when(probability <= 0.60, "Medium").when(probability.isNotNull(), "High")


def score_patients(trained: TrainedModel, matrix: DataFrame, low_includes_edge: bool = True) -> DataFrame:
    """probability to four decimals and band for every patient, highest first."""
    keep = ["patient_id", "churn_flag", "total_billed", "days_since_visit", "appointment_count", "avg_overall_score"]
    scored = probabilities(trained.model, matrix, number_columns(matrix))
    band = risk_band(F.col("churn_probability"), low_includes_edge)
    return scored.withColumn("risk_band", band).select(
        *[c for c in keep if c in matrix.columns],
        round_half_up(F.col("churn_probability"), 4).alias("churn_probability"), "risk_band",
    ).orderBy(F.desc("churn_probability"), "patient_id")


def band_scores(scores: DataFrame, low_includes_edge: bool = False) -> DataFrame:
    """Put a band next to any probability column."""
    return scores.withColumn("risk_band", risk_band(F.col("churn_probability"), low_includes_edge))


def revenue_at_risk(scored: DataFrame) -> DataFrame:
    """billed value times probability for every patient who has not churned."""
    return scored.filter("churn_flag = 0").withColumn(
        "revenue_at_risk", round_half_up(F.col("total_billed").cast("double") * F.col("churn_probability"), 6)
    )


def _fixed(column: str, digits: int = 6) -> Column:
    return F.col(column).cast(f"decimal(28,{digits})")


def risk_summary(scored: DataFrame) -> DataFrame:
    """patients, probability, billed and revenue at risk per band of active patients, in band order."""
    order = F.element_at(F.create_map(*[F.lit(x) for i, b in enumerate(BANDS) for x in (b, i)]), F.col("risk_band"))
    return (
        revenue_at_risk(scored).groupBy("risk_band").agg(
            F.count("*").alias("patients"),
            round_half_up(mean(_fixed("churn_probability")), 4).alias("avg_churn_prob"),
            money(F.sum("total_billed")).alias("total_billed"),
            round_half_up(F.sum(_fixed("revenue_at_risk"))).alias("revenue_at_risk"),
        ).orderBy(order)
    )


def risk_totals(scored: DataFrame) -> DataFrame:
    """active patients, total revenue at risk, and the High band's part."""
    at_risk = _fixed("revenue_at_risk")
    return revenue_at_risk(scored).agg(
        F.count("*").alias("active_patients"),
        round_half_up(F.sum(at_risk)).alias("total_revenue_at_risk"),
        round_half_up(F.sum(F.when(F.col("risk_band") == "High", at_risk).otherwise(0))).alias("high_risk_revenue"),
    )


def retention_list(scored: DataFrame, patients: DataFrame, limit: int = 20) -> DataFrame:
    """F8: the active High-band patients with most revenue at risk, with their profile (ties by id)."""
    profile = patients.select(
        "patient_id", "full_name", "state", "insurance_type", "health_fund", "age", "chronic_conditions"
    )
    top = (
        revenue_at_risk(scored).filter(F.col("risk_band") == "High")
        .select("patient_id", "total_billed", "churn_probability", "revenue_at_risk")
        .orderBy(F.desc("revenue_at_risk"), "patient_id").limit(limit)
    )
    return top.join(profile, "patient_id", "left").select(
        *profile.columns, "total_billed", "churn_probability", "revenue_at_risk"
    ).orderBy(F.desc("revenue_at_risk"), "patient_id")


def band_distribution(scored: DataFrame) -> DataFrame:
    """patients and share per band."""
    total = scored.agg(F.count("*").alias("__all"))
    rows = scored.groupBy("risk_band").agg(F.count("*").alias("patients"))
    return with_scalars(rows, total).withColumn("share_pct", rate_pct(F.col("patients"), F.col("__all"), 1)).drop("__all")
