"""Query of language-model scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinionlens.llm.common import crc_remainder, read_table
from opinionlens.llm.kneser_ney import fit_kneser_ney, score_texts

HELD_OUT = 2
COLUMNS = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op6_kneser_ney(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents").select("doc_id", "text")
    part = crc_remainder(F.col("doc_id"), 7)
    model = fit_kneser_ney(docs, part != HELD_OUT)
    held_out = F.coalesce(part == HELD_OUT, F.lit(False))
    return score_texts(docs, model).withColumn("held_out", held_out).select(*COLUMNS)
