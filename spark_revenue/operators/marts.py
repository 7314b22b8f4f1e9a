"""Named views and their health check."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F


def refresh_summaries(views: dict[str, DataFrame]) -> DataFrame:
    """Row count of every view."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("view_name"), "row_count")
        for name, df in views.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def register_views(views: dict[str, DataFrame]) -> None:
    """Create or replace a temporary view per name."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)


def views_of(spark: SparkSession, totals: dict[str, str]) -> DataFrame:
    """Rows and one total of each registered view, asked through the catalog; ``totals`` maps view to expression."""
    asked = [
        f"SELECT '{name}' AS view_name, count(*) AS row_count, CAST(CAST({total} AS DECIMAL(38,2)) AS DOUBLE) AS total FROM {name}"
        for name, total in totals.items()
    ]
    return spark.sql(" UNION ALL ".join(asked))


def _files(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), found


def _exists(spark: SparkSession, path: str) -> bool:
    system, found = _files(spark, path)
    return system.exists(found)


def drop(spark: SparkSession, path: str) -> None:
    system, found = _files(spark, path)
    system.delete(found, True)


def _digests(df: DataFrame, month: str) -> DataFrame:
    """Per month the number of rows and a sum of row hashes, which no order of rows changes."""
    row = F.xxhash64(*[F.col(f"`{c}`") for c in sorted(df.columns)]).cast("decimal(38,0)")
    return df.groupBy(month).agg(F.count("*").alias("rows"), F.sum(row).alias("digest"))


def refresh_by_month(df: DataFrame, path: str, month: str = "month") -> list[str]:
    """Bring a mart partitioned by month up to date, rewriting only months whose rows differ.

    The new rows are worked out once and staged beside the mart.  Months that are gone lose their partition;
    rows without a month have one of their own.  Returns the months written or removed.
    """
    spark = df.sparkSession
    staging = f"{path}-{uuid.uuid4().hex}"
    df.write.parquet(staging)
    staged = spark.read.schema(df.schema).parquet(staging)
    fresh = _digests(staged, month)
    if _exists(spark, path):
        stored = _digests(spark.read.schema(df.schema).parquet(path), month)
        stored = stored.select(F.col(month).alias("__month"), F.col("rows").alias("__rows"), F.col("digest").alias("__digest"))
        both = fresh.join(stored, F.col(month).eqNullSafe(F.col("__month")), "full")
        differ = both.filter(~(F.col("rows").eqNullSafe(F.col("__rows")) & F.col("digest").eqNullSafe(F.col("__digest"))))
        # A row for each month of the mart.
        found = differ.select(F.when(F.col("rows").isNull(), F.col("__month")).otherwise(F.col(month)).alias("m"), F.col("rows").isNull().alias("gone")).collect()
    else:
        found = fresh.select(F.col(month).alias("m"), F.lit(False).alias("gone")).collect()
    for r in found:
        if r["gone"]:
            drop(spark, f"{path}/{month}={'__HIVE_DEFAULT_PARTITION__' if r['m'] is None else r['m']}")
    changed = spark.createDataFrame([(r["m"],) for r in found if not r["gone"]], staged.select(F.col(month).alias("m")).schema)
    rows = staged.join(F.broadcast(changed), F.col(month).eqNullSafe(F.col("m")), "left_semi")
    rows.hint("rebalance", month).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(month).parquet(path)
    drop(spark, staging)
    return sorted(str(r["m"]) for r in found)


def refresh_marts(marts: dict[str, DataFrame], folder: str) -> dict[str, list[str] | None]:
    """Write every mart, those with a month by changed months; months touched per mart, None for whole ones."""
    done: dict[str, list[str] | None] = {}
    for name, df in marts.items():
        path = f"{folder}/{name}"
        if "month" in df.columns:
            done[name] = refresh_by_month(df, path)
        else:
            df.write.mode("overwrite").parquet(path)
            done[name] = None
    return done


def read_marts(spark: SparkSession, marts: dict[str, DataFrame], folder: str) -> dict[str, DataFrame]:
    """The marts as they were written."""
    return {name: spark.read.schema(df.schema).parquet(f"{folder}/{name}") for name, df in marts.items()}
