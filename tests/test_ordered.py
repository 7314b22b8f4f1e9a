"""The sliced window results equal plain windows, with hot keys, ties and one giant value."""

import pytest
from pyspark.sql import Window, functions as F

from spark_revenue.functions.ordered import _with_slices, exact_quantiles, ordered_measures


def frame(spark):
    # A third of the rows share key 'a'; a third of all rows share one value.
    return spark.range(6000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, "a").otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))).alias("k"),
        F.when(F.col("id") % 2 == 0, 7).otherwise((F.col("id") * 7919) % 997).cast("decimal(10,2)").alias("v"),
    )


@pytest.mark.parametrize("keys", [[], ["k"]])
@pytest.mark.parametrize("value_desc,tie_desc", [(False, False), (True, False), (False, True)])
def test_equals_plain_window(spark, keys, value_desc, tie_desc):
    df = frame(spark)
    got = ordered_measures(
        df, keys, "v", "id", value_desc=value_desc, tie_desc=tie_desc, row_number="rn", rank="rk",
        dense_rank="dr", running={"run": "v"}, ends=("lo", "hi"),
    )
    by_v = F.desc("v") if value_desc else F.asc("v")
    w = Window.partitionBy(*keys).orderBy(by_v)
    r = Window.partitionBy(*keys).orderBy(by_v, F.desc("id") if tie_desc else F.asc("id"))
    want = df.select(
        "id", "k", "v", F.row_number().over(r).alias("rn"), F.rank().over(w).alias("rk"),
        F.dense_rank().over(w).alias("dr"),
        F.sum("v").over(r.rowsBetween(Window.unboundedPreceding, 0)).alias("run"),
        F.min("v").over(Window.partitionBy(*keys)).alias("lo"), F.max("v").over(Window.partitionBy(*keys)).alias("hi"),
    )
    cast = [F.col(c).cast("string") for c in ("id", "rn", "rk", "dr", "lo", "hi")] + [F.col("run").cast("double")]
    assert sorted(map(tuple, got.select(*cast).collect())) == sorted(map(tuple, want.select(*cast).collect()))


def test_groups_are_cut_evenly_and_in_order(spark):
    df = frame(spark)
    for keys in ([], ["k"]):
        order = [F.col("v").isNull(), F.col("v"), F.col("id")]
        cut = _with_slices(df, keys, order, 64).withColumn("at", F.struct(*keys, "v", "id"))
        rows = cut.groupBy("__slice").agg(F.count("*").alias("n"), F.min("at").alias("lo"), F.max("at").alias("hi")).orderBy("__slice").collect()
        assert len(rows) > 48 and max(r["n"] for r in rows) < 6000 / 64 * 2.5
        assert all(a["hi"] < b["lo"] for a, b in zip(rows, rows[1:]))


def test_one_plan_for_any_size(spark):
    """No job while the plan is built, no group in one task, one pass of offsets that is broadcast."""
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan", "building")
    for rows in (0, 10, 10_000_000):
        df = spark.range(rows).select("id", (F.col("id") % 2).alias("k"), (F.col("id") % 9).alias("v"))
        got = ordered_measures(df, ["k"], "v", "id", row_number="rn", rank="rk", dense_rank="dr", running={"s": "v"})
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(k" in plan and "__slice" in plan and "BroadcastHashJoin" in plan
    assert not tracker.getJobIdsForGroup("plan")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("desc", [False, True])
def test_values_that_go_on_over_slices(spark, desc):
    """Long runs of equal values, nulls among them, in groups of every size: ranks and running sums."""
    df = spark.range(8000).select(
        "id", F.when(F.col("id") % 5 == 0, None).otherwise(F.col("id") % 2).alias("k"),
        F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, 5).otherwise(F.col("id") % 40).alias("v"),
        F.when(F.col("id") % 7 > 0, F.col("id") % 11).alias("x"),
    )
    got = ordered_measures(df, ["k"], "v", "id", value_desc=desc, row_number="rn", rank="rk", dense_rank="dr", running={"s": "x"}, ends=("lo", "hi"))
    by_v = F.desc_nulls_first("v") if desc else F.asc_nulls_last("v")
    w, r = Window.partitionBy("k").orderBy(by_v), Window.partitionBy("k").orderBy(by_v, "id")
    want = df.select("*", F.row_number().over(r).alias("rn"), F.rank().over(w).alias("rk"), F.dense_rank().over(w).alias("dr"),
                     F.sum("x").over(r.rowsBetween(Window.unboundedPreceding, 0)).alias("s"),
                     F.min("v").over(Window.partitionBy("k")).alias("lo"), F.max("v").over(Window.partitionBy("k")).alias("hi"))
    assert got.columns == want.columns
    assert got.orderBy("id").collect() == want.orderBy("id").collect()


def test_empty_table_and_descending_text(spark):
    empty = spark.range(0).select(F.lit("a").alias("k"), F.col("id").alias("v"), F.col("id").alias("t"))
    assert ordered_measures(empty, ["k"], "v", "t", row_number="n", running={"s": "v"}).collect() == []
    with pytest.raises(ValueError):
        ordered_measures(empty, [], "k", "t", value_desc=True, row_number="n")


def test_exact_quantiles(spark):
    df = frame(spark).filter("id % 2 = 1")
    probs = {"q1": 0.25, "q2": 0.5, "q3": 0.75}
    got = exact_quantiles(df, "v", probs).first()
    want = df.agg(*[F.percentile(F.col("v").cast("double"), p).alias(n) for n, p in probs.items()]).first()
    for name in probs:
        assert got[name] == pytest.approx(want[name])


def test_hot_null_key_is_cut_and_numbered(spark):
    from pyspark.sql import Window, functions as F

    from spark_revenue.functions.ordered import ordered_measures

    df = spark.range(3000).select(
        F.when(F.col("id") % 10 < 7, F.lit(None)).otherwise((F.col("id") % 3).cast("string")).alias("k"),
        (F.col("id") * 7919 % 501).alias("v"), F.col("id").alias("t"),
    )
    got = ordered_measures(df, ["k"], "v", "t", row_number="n", running={"s": "v"})
    window = Window.partitionBy("k").orderBy("v", "t")
    want = df.withColumn("n", F.row_number().over(window)).withColumn("s", F.sum("v").over(window.rowsBetween(Window.unboundedPreceding, 0)))
    assert sorted(map(tuple, got.select("t", "n", "s").collect())) == sorted(map(tuple, want.select("t", "n", "s").collect()))
