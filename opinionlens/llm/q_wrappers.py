"""Query of HTML extraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from opinionlens.llm.common import read_table
from opinionlens.llm.wrappers import extract_text


def op11_html_extraction(spark: SparkSession, sf: str) -> DataFrame:
    pages = read_table(spark, sf, "pages").select("page_id", "url", "html")
    return extract_text(pages).select("page_id", "url", "text", "n_chars")
