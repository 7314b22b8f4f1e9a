"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import cover_dedup, gnat, grammar_store, importance, licenses, mixing, odd_sketch, quality_rules, secret_index, suffix_dedup, templates, tool_calls, turn_repair
from .oracles import ORACLE

Query = Callable[[SparkSession, str], DataFrame]


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = tool_calls.calls_of(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return tool_calls.link(calls, results, tool_calls.CHAT_SCHEMAS)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(_documents(spark, sf_dir))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.apply_rules(_documents(spark, sf_dir), carry=["doc_id"])


def tokenizer_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def op4_token_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grammar_store.tokenise(_documents(spark, sf_dir), tokenizer_path())


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_documents(spark, sf_dir).select("doc_id", "source", "text"))
    return mixed.select("doc_id", "size", "source_size", "target", "copies", "taken")


def op6_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return importance.resample(_documents(spark, sf_dir), labels, carry=["doc_id"])


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return templates.decontaminate(_documents(spark, sf_dir), benchmark, carry=["doc_id"])


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_index.scan(_documents(spark, sf_dir), carry=["doc_id"]).drop("found")


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return odd_sketch.near_duplicates(_documents(spark, sf_dir))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_documents(spark, sf_dir), carry=["doc_id"]).drop("found")


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.audit(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gnat.mine(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_cover_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_dedup.remove_repeats(_documents(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "op1_tool_calls": op1_tool_calls,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_quality_rules": op3_quality_rules,
    "op4_token_grammar": op4_token_grammar,
    "op5_mixing": op5_mixing,
    "op6_importance": op6_importance,
    "op7_decontaminate": op7_decontaminate,
    "op8_secrets": op8_secrets,
    "op9_near_duplicates": op9_near_duplicates,
    "op10_licenses": op10_licenses,
    "op11_turn_repair": op11_turn_repair,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_cover_dedup": op13_cover_dedup,
}

__all__ = ["ORACLE", "QUERIES"]
