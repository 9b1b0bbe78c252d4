"""Query of the licence scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinionlens.llm.common import read_table
from opinionlens.llm.licences import scan_licences


def op9_licence_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as files: by source, then ten thousands, then hundreds of the id.

    One whose first line speaks of a licence is its directory's licence file.
    """
    docs = read_table(spark, sf, "documents").select("doc_id", "text", "source")
    notice = F.lower(F.substring_index("text", "\n", 1)).rlike("licen[cs]e")
    name = F.concat(F.when(notice, F.lit("LICENSE-")).otherwise(F.lit("doc-")), "doc_id")
    folder = F.concat_ws("/", "source", F.expr("cast(doc_id div 10000 as string)"), F.expr("cast(doc_id div 100 as string)"))
    return scan_licences(docs.select("doc_id", "text", F.concat_ws("/", folder, name).alias("path")))
