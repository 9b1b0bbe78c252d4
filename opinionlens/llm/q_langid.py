"""Query of language identification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opinionlens.llm.common import crc_remainder, read_table
from opinionlens.llm.langid import identify_languages, sample_languages

HELD_OUT = 2


def held_out() -> Column:
    return F.coalesce(crc_remainder(F.col("doc_id"), 4) == HELD_OUT, F.lit(False))


def op3_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents")
    samples = sample_languages(docs, crc_remainder(F.col("doc_id"), 4) != HELD_OUT)
    found = identify_languages(docs.select("doc_id", "text"), samples)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
