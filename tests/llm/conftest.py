import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[2]
sys.path.insert(0, str(ROOT))

DOCS = "doc_id long, text string, lang string, source string, n_chars int"


@pytest.fixture
def documents(spark: SparkSession):
    """Documents from (id, text) or (id, text, lang, source) with extra columns whose names clash."""

    def make(rows):
        full = [(*r, "en", "s0")[:4] if len(r) == 2 else r for r in rows]
        frame = spark.createDataFrame([(*r, 1) for r in full], DOCS)
        return frame.selectExpr("*", "1 AS kept", "'x' AS n_words", "2 AS size", "'y' AS labels", "3 AS score", "0 AS copies")

    return make


def by_id(frame):
    return {r["doc_id"]: r for r in frame.collect()}
