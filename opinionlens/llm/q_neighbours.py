"""Query of approximate nearest neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from opinionlens.llm.common import read_table
from opinionlens.llm.neighbours import nearest_neighbours


def op8_nearest_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    vectors = read_table(spark, sf, "embeddings").select("vec_id", "embedding")
    return nearest_neighbours(vectors, lambda vec_id: vec_id % 50 == 0, k=5)
