"""Query of exact piece encoding."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from opinionlens.llm.bpe import encode_texts
from opinionlens.llm.common import read_table


def op5_piece_encoding(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents").select("doc_id", "text")
    return encode_texts(docs, public_tokenizers.path("piece_bpe_32k.model"), ids=False, digests=True).drop("text")
