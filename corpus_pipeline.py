"""From documents to token blocks: quality rules, near duplicates, benchmark leaks, mixing, tokens."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from spark_revenue.llm import grammar_store, mixing, odd_sketch, quality_rules, templates
from spark_revenue.llm.queries import tokenizer_path
from spark_revenue.llm.shared import Scratch

# Adaptive thresholds, MinHash and grammars are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.apply_rules(docs).filter("kept").select(*[F.col(f"`{c}`") for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return odd_sketch.deduplicate(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    marked = templates.decontaminate(docs, benchmark)
    return marked.filter(~F.col("contaminated")).select(*[F.col(f"`{c}`") for c in docs.columns])


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.emit(mixing.mix(docs), docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids written as grammar blocks in ascending document order, and read back."""
    return grammar_store.tokenise(docs, tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixture),
    ("token_grammar", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written and read again."""
    scratch = Scratch(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for n, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n < len(STAGES) - 1:
            docs = scratch.save(docs, name)
            if n:
                scratch.drop(STAGES[n - 1][0])
    return docs
