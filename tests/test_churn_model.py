"""Properties of features, training, scoring and importances on the 30-patient fixture."""

import pytest
from fixtures import churn_tables
from pyspark.sql import functions as F

from spark_revenue.operators import explain as x
from spark_revenue.operators import features as f
from spark_revenue.operators import linear as lin
from spark_revenue.operators import model as m
from spark_revenue.operators import validation as v
from spark_revenue.operators.model_store import ModelStore, data_version


@pytest.fixture(scope="module")
def features(spark):
    return f.build_features(*churn_tables(spark)).cache()


@pytest.fixture(scope="module")
def matrix(features):
    return f.model_matrix(features).cache()


@pytest.fixture(scope="module")
def boosted(matrix):
    return m.train_model(matrix, "gbt", trees=5, exact_split=True)


@pytest.fixture(scope="module")
def logistic(matrix):
    return m.train_model(matrix, "logistic", exact_split=True)


@pytest.fixture(scope="module")
def scored(boosted, matrix):
    return m.score_patients(boosted, matrix).collect()


def test_one_row_per_patient(features):
    assert features.count() == 30
    assert features.select("patient_id").distinct().count() == 30


def test_hand_checked_values(features):
    got = {r.patient_id: r for r in features.collect()}
    for p, r in got.items():
        assert (r.days_since_visit, r.appointment_count, r.avg_wait_days) == (0, 3, 6.0)
        assert (r.no_show_rate, r.telehealth_rate, r.avg_billed) == (0.333333, 0.333333, 100.0 + 10 * p)
    assert (got[2].avg_overall_score, got[2].avg_wait_rating, got[2].complaint_count) == (3.0, 2.0, 1)
    assert all((got[p].avg_overall_score, got[p].avg_wait_rating, got[p].complaint_count) == (5.0, 3.0, 0)
               for p in range(4, 31))


def test_target_is_present(features):
    assert "churn_flag" in features.columns


def test_no_nulls_in_numbers(matrix):
    numeric = [c for c, t in matrix.dtypes if t != "string"]
    assert matrix.select(sum(F.count_if(F.col(f"`{c}`").isNull()) for c in numeric)).first()[0] == 0


def test_ranges(features):
    assert features.filter("days_since_visit < 0 OR no_show_rate NOT BETWEEN 0 AND 1 "
                           "OR telehealth_rate NOT BETWEEN 0 AND 1").count() == 0


def test_one_hot_null_is_all_zero(matrix):
    columns = [c for c in matrix.columns if c.startswith("chronic_conditions_")]
    assert sorted(columns) == ["chronic_conditions_Asthma", "chronic_conditions_Diabetes", "chronic_conditions_Hypertension"]
    row = matrix.filter("patient_id = 2").first()
    assert [row[c] for c in columns] == [0, 0, 0]


def test_drop_first(features):
    assert "ins_bulk_bill" not in f.one_hot(features, {"insurance_type": "ins"}, drop_first=True).columns


def test_training_result(boosted):
    assert boosted.model and boosted.feature_names and boosted.test.count() == 6
    assert isinstance(boosted.metrics["roc_auc"], float)
    assert 0.0 <= boosted.metrics["roc_auc"] <= 1.0


def test_logistic_model(logistic):
    assert logistic.model is not None
    assert logistic.model.stages[-1].coefficients.size == len(logistic.feature_names)


def test_feature_names_match_matrix(boosted, matrix):
    assert len(boosted.feature_names) == len(matrix.columns) - 2


def test_exact_split_is_stratified(matrix):
    got = m.stratified_split(matrix, exact=True).filter("is_test").groupBy("churn_flag").count().collect()
    assert sorted(tuple(r) for r in got) == [(0, 3), (1, 3)]


def test_split_does_not_depend_on_partitions(matrix):
    one = {r.patient_id for r in m.stratified_split(matrix.coalesce(1)).filter("is_test").collect()}
    many = {r.patient_id for r in m.stratified_split(matrix.repartition(7)).filter("is_test").collect()}
    assert one == many


def test_scores(scored):
    assert len(scored) == 30
    assert all(0.0 <= r.churn_probability <= 1.0 for r in scored)
    assert {r.risk_band for r in scored} <= {"Low", "Medium", "High"}
    probs = [r.churn_probability for r in scored]
    assert probs == sorted(probs, reverse=True)


def test_importance(spark, boosted, logistic):
    for trained in (boosted, logistic):
        table = x.feature_importance(spark, trained, 3).collect()
        assert len(table) <= 3
        assert all(r.importance >= 0 and r.feature for r in table)


def test_attributions_add_up_to_the_log_odds(logistic, matrix):
    scored = m.score_patients(logistic, matrix)
    rows = x.explain_patient(logistic, matrix, scored).collect()
    top = m.probabilities(logistic.model, matrix, logistic.feature_names)
    top = top.filter(F.col("patient_id") == rows[0].patient_id).first().churn_probability
    total = rows[0].base_value + sum(r.contribution for r in rows)
    assert 1 / (1 + 2.718281828459045 ** -total) == pytest.approx(top, abs=1e-3)


def test_ranking_quality_on_known_scores(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.8), (1, 0.7), (0, 0.1)], "churn_flag int, churn_probability double")
    row = m.ranking_quality(df).first()
    assert (row.roc_auc, row.avg_precision) == (0.75, round((1 + 2 / 3) / 2, 4))
    assert m.roc_points(df).count() == 4


@pytest.mark.parametrize("kind", ["logistic", "gbt"])
def test_cross_validation(matrix, kind):
    by_fold = v.cross_validate(matrix, kind, folds=2, trees=3)
    got = v.cross_validation_summary(by_fold).first()
    assert [r["fold"] for r in by_fold.orderBy("fold").collect()] == [0, 1]
    assert 0.0 <= got["cv_roc_auc_mean"] <= 1.0 and got["cv_roc_auc_std"] >= 0.0


def test_boosted_folds_share_one_stored_table(spark, monkeypatch):
    """All folds train on one table of vectors in few parts, and score as models that know their own rows' categories only."""
    rows = spark.range(0, 400, 1, 16).select(
        F.col("id").alias("patient_id"), (F.pmod(F.xxhash64("id"), F.lit(10)) < F.col("id") * 7 % 10).cast("int").alias("churn_flag"),
        (F.col("id") * 7 % 10).cast("double").alias("visits"), (F.col("id") * 31 % 17).cast("double").alias("noise"),
        F.array(F.concat(F.lit("v"), F.when(F.col("id") % 50 == 0, F.col("id")).otherwise(F.col("id") % 3))).alias("categories"),
    )
    folded = v.materialise(rows.withColumn("fold", (F.col("patient_id") % 4).cast("int")))
    monkeypatch.setattr(v, "stratified_folds", lambda *_: folded)
    read, boost = [], v.boost
    monkeypatch.setattr(v, "boost", lambda part, *rest: read.append(part) or boost(part, *rest))
    got = {r["fold"]: r["roc_auc"] for r in v.cross_validate(rows, "gbt", folds=4, trees=5, at_once=4).collect()}

    assert {part.rdd.getNumPartitions() for part in read} == {v.boosting_parts(400, spark.sparkContext.defaultParallelism, 4)}
    plans = [part._jdf.queryExecution().optimizedPlan().toString() for part in read]
    assert len(plans) == 4 and all("LogicalRDD" in p and "InMemoryRelation" not in p and "UDF" not in p for p in plans)
    tables = [leaf for part in read for leaf in [part._jdf.queryExecution().optimizedPlan().collectLeaves().head()]]
    assert len({t.rdd().id() for t in tables}) == 1

    names, parts = m.number_columns(rows), read[0].rdd.getNumPartitions()
    grouped = v.materialise(folded.coalesce(parts))
    for fold in range(4):
        alone = m.fit(grouped.filter(F.col("fold") != fold).drop("fold"), names, "gbt", trees=5)
        scored = m.probabilities(alone, grouped.filter(F.col("fold") == fold).drop("fold"), names)
        assert got[fold] == m.ranking_quality(scored).first()["roc_auc"]
    assert min(got.values()) < 1.0


def test_parts_of_boosting_grow_with_the_rows():
    assert v.boosting_parts(0, 12, 5) == v.boosting_parts(900_000, 12, 5) == 5
    assert v.boosting_parts(5_400_000, 12, 5) == 22 and v.boosting_parts(1000, 12, 1) == 24


def test_folds_are_stratified_and_stable(spark):
    df = spark.range(1003).select(F.col("id").alias("patient_id"), (F.col("id") % 7 < 2).cast("int").alias("churn_flag"))
    folded = v.stratified_folds(df)
    sizes = {}
    for r in v.fold_sizes(folded).collect():
        sizes.setdefault(r["churn_flag"], []).append(r["rows"])
    assert all(len(n) == 5 and max(n) - min(n) <= 1 for n in sizes.values())
    again = v.stratified_folds(df.repartition(13).orderBy(F.desc("patient_id")))
    assert sorted(folded.collect()) == sorted(again.collect())
    assert v.stratified_folds(df.limit(0)).collect() == []


def test_classification_report_of_three_classes(spark):
    rows = [("a", "a")] * 5 + [("a", "b")] * 2 + [("b", "b")] * 3 + [("c", "a")] + [("b", "d")] + [(None, "a"), ("a", None)]
    got = {r["class"]: tuple(r)[1:] for r in v.classification_report(spark.createDataFrame(rows, "label string, predicted string")).collect()}
    assert got["a"] == (0.8333, 0.7143, 0.7692, 7)
    assert got["b"] == (0.6, 0.75, 0.6667, 4)
    assert got["c"] == (0.0, 0.0, 0.0, 1) and got["d"] == (0.0, 0.0, 0.0, 0)
    assert got["accuracy"] == (0.6667, 0.6667, 0.6667, 12)
    assert got["macro avg"] == (0.3583, 0.3661, 0.359, 12)
    assert got["weighted avg"] == (0.6861, 0.6667, 0.6709, 12)
    assert v.classification_report(spark.createDataFrame([], "label string, predicted string")).collect() == []


def test_five_thousand_categories(spark):
    """Codes, training and attributions with more values than a wide table could name."""
    rows = spark.range(9000).select(
        F.col("id").alias("patient_id"), F.when(F.col("id") % 3 > 0, F.concat(F.lit("v"), F.col("id") % 7000)).alias("insurance_type"),
        F.lit("S").alias("state"), F.when(F.col("id") % 2 == 0, "Asthma; Gout").alias("chronic_conditions"),
        (F.col("id") % 2).cast("int").alias("churn_flag"), (F.col("id") % 11).cast("double").alias("visits"),
    )
    coded = f.coded_matrix(rows)
    dictionary = f.fit_dictionary(coded)
    values = [r["value"] for r in dictionary.orderBy("index").collect()]
    assert values == sorted(values) and len(values) > 5000 and {"state_S", "chronic_conditions_Gout"} <= set(values)
    codes = {r["patient_id"]: r for r in f.encode(coded, dictionary).collect()}
    assert len(codes) == 9000 and {r["size"] for r in codes.values()} == {len(values)}
    assert [values[i] for i in codes[4]["indices"]] == ["chronic_conditions_Asthma", "chronic_conditions_Gout", "insurance_type_v4", "state_S"]
    assert [values[i] for i in codes[3]["indices"]] == ["state_S"]
    trained = m.train_model(coded, "logistic")
    # The model knows the values of the rows it was trained on.
    assert len(trained.feature_names) > 4000 and trained.metrics["roc_auc"] > 0.9
    table = lin.coefficient_table(spark, trained)
    ours = {r["patient_id"]: r["churn_probability"] for r in lin.linear_scores(coded, table).collect()}
    theirs = m.probabilities(trained.model, coded, m.number_columns(coded)).select("patient_id", "churn_probability").collect()
    assert all(ours[r["patient_id"]] == pytest.approx(r["churn_probability"], abs=1e-6) for r in theirs)


def test_logistic_fit_has_no_gradient_left(matrix):
    """At the fit the gradient of the penalised, weighted log-loss is zero in every coefficient."""
    names = m.number_columns(matrix)
    model = m.fit(matrix, names, "logistic")
    rows = model.transform(m._weighted(matrix, "churn_flag").select("label", "weight", *[F.col(f"`{c}`").cast("double") for c in names]))
    data = rows.select("label", "weight", "features", "probability").collect()
    coefficients = model.stages[-1].coefficients.toArray()
    total = sum(r["weight"] for r in data)
    gradient = sum(r["weight"] * (r["probability"][1] - r["label"]) * r["features"].toArray() for r in data) / total + coefficients / len(data)
    assert abs(gradient).max() < 1e-4
    assert abs(sum(r["weight"] * (r["probability"][1] - r["label"]) for r in data)) / total < 1e-4


def test_importances_sum_to_one_and_follow_the_driving_feature(spark):
    rows = spark.range(400).select(
        F.col("id").alias("patient_id"), (F.col("id") % 10 < 5).cast("int").alias("churn_flag"), (F.col("id") % 10).cast("double").alias("driver"),
        (F.col("id") * 37 % 11).cast("double").alias("noise"),
    )
    for kind, sign in (("gbt", 0), ("logistic", -1)):
        trained = m.train_model(rows, kind, trees=5)
        table = x.feature_importance(spark, trained, 9).collect()
        assert table[0]["feature"] == "driver"
        if kind == "gbt":
            assert sum(r["importance"] for r in table) == pytest.approx(1.0)
        else:
            assert trained.model.stages[-1].coefficients[trained.feature_names.index("driver")] * sign > 0


def test_model_store(spark, matrix, tmp_path):
    """A model is trained once for a state of the data, and read back whole."""
    store, calls = ModelStore(spark, str(tmp_path / "models")), []

    def train():
        calls.append(1)
        return m.train_model(matrix, "logistic", exact_split=True)

    for _ in range(2):
        store.ensure("logistic", "one", train)
    assert len(calls) == 1 and ("logistic", "two") not in store
    loaded, fresh = store.load("logistic", "one"), train()
    assert loaded.feature_names == fresh.feature_names and loaded.metrics == fresh.metrics
    assert sorted(loaded.test.select("patient_id", "churn_probability").collect()) == sorted(fresh.test.select("patient_id", "churn_probability").collect())
    matrix.limit(3).write.parquet(str(tmp_path / "data"))
    before = data_version(spark, str(tmp_path / "data"))
    assert before == data_version(spark, str(tmp_path / "data"))
    matrix.limit(4).write.mode("append").parquet(str(tmp_path / "data"))
    assert before != data_version(spark, str(tmp_path / "data"))


def test_conditions_split_and_slugged(spark):
    df = spark.createDataFrame([(1, "Diabetes; Heart Disease"), (2, None), (3, "Asthma,Diabetes")],
                               "patient_id int, chronic_conditions string")
    table = f.condition_flags(df)
    assert table.columns == ["patient_id", "chronic_asthma", "chronic_diabetes", "chronic_heart_disease", "chronic_none"]
    assert sorted(tuple(r) for r in table.collect()) == [(1, 0, 1, 1, 0), (2, 0, 0, 0, 1), (3, 1, 1, 0, 0)]


def test_vocabulary_refuses_free_text(spark):
    with pytest.raises(ValueError):
        f.vocabulary(spark.range(20).select(F.col("id").cast("string").alias("x")), "x", limit=10)
