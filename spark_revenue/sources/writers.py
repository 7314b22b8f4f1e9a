"""Writing tables, marts and recommendations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.quality import table_profile
from ..operators.recommend import COLUMNS
from ..schema import TABLES

# Fact tables are laid out by month, which the monthly reports and date filters prune on.
MONTH_OF = {"appointments": "appointment_date", "billing_claims": "claim_date"}


def by_month(df: DataFrame, date: str) -> DataFrame:
    """Rows grouped by month for a partitioned write; AQE splits a month that is too big for one task."""
    return df.withColumn("month", F.trunc(date, "MM")).hint("rebalance", "month")


def save_tables(tables: dict[str, DataFrame], database: str | None = None, partitioned: bool = True) -> list[str]:
    """S3: replace the five tables in the catalog, parents before children, as Parquet."""
    written = []
    for name in TABLES:
        if name not in tables:
            continue
        target = f"{database}.{name}" if database else name
        if partitioned and name in MONTH_OF:
            by_month(tables[name], MONTH_OF[name]).write.mode("overwrite").partitionBy("month").saveAsTable(target)
        else:
            tables[name].write.mode("overwrite").saveAsTable(target)
        written.append(target)
    return written


def save_tables_jdbc(tables: dict[str, DataFrame], url: str, properties: dict[str, str] | None = None) -> list[str]:
    """S3 to a database: the same replacement through Spark's JDBC writer."""
    written = [name for name in TABLES if name in tables]
    for name in written:
        tables[name].write.mode("overwrite").jdbc(url, name, properties=properties or {})
    return written


def export_tables(tables: dict[str, DataFrame], folder: str) -> None:
    """Every cleaned table as Parquet, and as CSV with header."""
    _write_both(tables, folder)


def _write_both(frames: dict[str, DataFrame], folder: str) -> None:
    """Parquet first; the CSV is written from it, so each frame is computed once."""
    for name, df in frames.items():
        path = f"{folder}/{name}.parquet"
        df.write.mode("overwrite").parquet(path)
        written = df.sparkSession.read.schema(df.schema).parquet(path)
        written.write.mode("overwrite").option("header", True).csv(f"{folder}/{name}.csv")


def write_marts(marts: dict[str, DataFrame], folder: str, csv: bool = True) -> None:
    """Every mart as Parquet, and as CSV for people."""
    if csv:
        return _write_both(marts, folder)
    for name, df in marts.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")


def write_recommendations(recs: DataFrame, folder: str) -> None:
    """The recommendations as one CSV and one JSON file, eight columns in order (a few dozen rows)."""
    ordered = recs.select(*COLUMNS).orderBy("rec_id").coalesce(1)
    ordered.write.mode("overwrite").option("header", True).csv(f"{folder}/recommendations.csv")
    ordered.write.mode("overwrite").json(f"{folder}/recommendations.json")


def reload_check(spark: SparkSession, folder: str, names: list[str]) -> DataFrame:
    """Rows, columns and NULLs of the written tables, read back from disk."""
    return table_profile({name: spark.read.parquet(f"{folder}/{name}.parquet") for name in names})
