"""Documents to packed training sequences, in five stages.

Each stage works on all rows that the one before has kept, written as Parquet in
the shared folder. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinionlens.llm.common import read_table
from opinionlens.llm.jaccard import SetJoin, keep_one_of_each
from opinionlens.llm.langid import UNDETERMINED, identify_languages, sample_languages
from opinionlens.llm.packing import pack
from opinionlens.llm.quality import quality_rules
from opinionlens.llm.spans import dedup_spans
from opinionlens.session import materialize

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
PACKED = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")

#: A text whose phrases have fewer letters on average fits no language that was learned.
MIN_PHRASE_LETTERS = 2.0
NEAR = SetJoin(n=5, percent=80)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules(docs).filter("kept").select(*COLUMNS)


def keep_in_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones teach; with none labelled, all of them."""
    samples = sample_languages(docs, F.lit(True))
    if not samples.texts:
        return docs.select(*COLUMNS)
    found = identify_languages(docs.select(*COLUMNS), samples)
    return found.filter((F.col("lang_pred") != UNDETERMINED) & (F.col("phrase_letters") >= MIN_PHRASE_LETTERS)).select(*COLUMNS)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group that five-word shingles link at 0.8."""
    return keep_one_of_each(docs.select(*COLUMNS), NEAR)


def cut_repeated_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without sentence spans seen before; documents of which nothing is left go."""
    cut = dedup_spans(docs.select(*COLUMNS))
    left = cut.filter((F.col("n_removed") == 0) | F.col("text").rlike("[^\\x20\\x09-\\x0D]"))
    return left.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 1024 ids."""
    return pack(docs.select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json")).select(*PACKED)


STAGES = [
    ("quality rules", keep_good),
    ("language ID", keep_in_known_language),
    ("n-gram Jaccard join", keep_one_of_near_copies),
    ("substring dedup", cut_repeated_spans),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


# Language ID, sentence spans and packing have no SQL form; tests/llm/test_pipeline.py has a plain version.
ORACLE_SQL = None
