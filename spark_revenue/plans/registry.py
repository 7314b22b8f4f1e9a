"""Named queries: each binds an operator to the domain tables of one data folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..sources.binding import DomainTables

Job = Callable[[DomainTables], DataFrame]
JOBS: dict[str, Job] = {}


def job(name: str, build: Job) -> None:
    if name in JOBS:
        raise ValueError(f"query {name} registered twice")
    JOBS[name] = build


def portable(df: DataFrame) -> DataFrame:
    """Dates as ISO text and decimals as doubles, so any client reads the result the same way."""

    def convert(field: T.StructField):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, T.DateType):
            column = column.cast("string")
        return column.alias(field.name)

    return df.select(*[convert(f) for f in df.schema.fields])


def run(spark: SparkSession, path: str, name: str) -> DataFrame:
    return portable(JOBS[name](DomainTables(spark, path)))
