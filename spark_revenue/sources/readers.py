"""Reading the domain tables: raw CSV, cleaned CSV, catalog tables with a CSV fallback."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators.quality import parse_date
from ..schema import TABLES

CORRUPT = "_corrupt_record"


def raw_schema(table: str) -> T.StructType:
    """The table's schema with dates still as text, plus a column for unreadable lines."""
    fields = [
        T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.DateType) else f.dataType, True)
        for f in TABLES[table].fields
    ]
    return T.StructType([*fields, T.StructField(CORRUPT, T.StringType(), True)])


def read_raw_csv(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """One raw table with its header; lines that do not fit keep their text in ``_corrupt_record``.

    The text 'None' stays text: only empty cells are NULL.
    """
    return (
        spark.read.schema(raw_schema(table))
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(f"{folder}/{table}.csv")
    )


def read_raw_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {name: read_raw_csv(spark, folder, name) for name in TABLES}


def read_clean_csv(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """One table with its dates parsed, in the declared column order and types."""
    raw = read_raw_csv(spark, folder, table)
    return raw.select(*[
        parse_date(f.name).alias(f.name) if isinstance(f.dataType, T.DateType) else F.col(f.name)
        for f in TABLES[table].fields
    ])


def read_checked_csv(spark: SparkSession, folder: str, table: str) -> tuple[DataFrame, DataFrame]:
    """S2 with nothing lost in silence: the rows that fit, and the text of the lines that don't.

    Both come from the same read; counting the second tells how many lines were set aside.
    """
    raw = read_raw_csv(spark, folder, table)
    # Spark judges a line by the columns a query reads, so the filter reads them all.
    all_read = F.length(F.concat_ws("", *[f.name for f in TABLES[table].fields])) >= 0
    fits = raw.filter(all_read & F.col(CORRUPT).isNull()).select(*[
        parse_date(f.name).alias(f.name) if isinstance(f.dataType, T.DateType) else F.col(f.name)
        for f in TABLES[table].fields
    ])
    return fits, raw.filter(all_read & F.col(CORRUPT).isNotNull()).select(CORRUPT)


def csv_lines(df: DataFrame, table: str) -> DataFrame:
    """The rows of a table as lines of CSV, in the declared order of columns; NULL is an empty cell."""
    return df.select(F.to_csv(F.struct(*[f.name for f in TABLES[table].fields])).alias("line"))


def parse_lines(lines: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    """S1 and S2 on lines that have already been read: the rows that fit, with dates parsed, and the lines that don't.

    A line is set aside where a cell doesn't have its column's type or the number of cells is wrong.
    """
    # Named options keep Spark from reading only the columns asked for, by which a bad line would pass.
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    # Empty lines are no rows, as in a file.
    read = lines.filter(F.trim("line") != "").select("line", F.from_csv("line", raw_schema(table).simpleString()[7:-1].replace(":", " "), options).alias("row"))
    fits = read.filter(F.col(f"row.{CORRUPT}").isNull()).select("row.*").select(*[
        parse_date(f.name).alias(f.name) if isinstance(f.dataType, T.DateType) else F.col(f.name)
        for f in TABLES[table].fields
    ])
    return fits, read.filter(F.col(f"row.{CORRUPT}").isNotNull()).select("line")


def read_clean_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {name: read_clean_csv(spark, folder, name) for name in TABLES}


def _exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def load_table(spark: SparkSession, table: str, folder: str | None = None) -> DataFrame:
    """The catalog table, else the CSV in ``folder``, else an empty frame of the same schema."""
    if spark.catalog.tableExists(table):
        return spark.table(table)
    if folder and _exists(spark, f"{folder}/{table}.csv"):
        return read_clean_csv(spark, folder, table)
    return spark.createDataFrame([], TABLES[table])
