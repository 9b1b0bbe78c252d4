"""Query of substring dedup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from opinionlens.llm.common import read_table
from opinionlens.llm.spans import dedup_spans


def op7_sentence_spans(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents").select("doc_id", "text")
    return dedup_spans(docs)
