"""Vocabulary, bag of words and corpus term weights."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinionlens.functions.text import clean_text, explode_counts, tokenize, with_once
from opinionlens.operators.scaling import with_position
from opinionlens.session import materialize


def tokens_of(df: DataFrame, text: str = "text", out: str = "tokens") -> DataFrame:
    return with_once(df, **{out: tokenize(clean_text(text))})


def bag_of_words(df: DataFrame, doc_id: str = "doc_id", tokens: str = "tokens") -> DataFrame:
    """Long form (doc_id, word, cnt), counted inside each row without a shuffle."""
    return explode_counts(df, doc_id, tokens=tokens)


def vocabulary(df: DataFrame, tokens: str = "tokens") -> DataFrame:
    """Distinct words with document frequency and total count.

    Words are counted per row and per partition before the only shuffle, so
    a word found in every document sends one row per partition.
    """
    return explode_counts(df, tokens=tokens).groupBy("word").agg(F.count("*").alias("df"), F.sum("cnt").alias("cnt"))


def word_totals(df: DataFrame, tokens: str = "tokens") -> DataFrame:
    """(word, cnt): the vocabulary without document frequencies, which take a sort of every row's words."""
    return df.select(F.explode(tokens).alias("word")).filter(F.col("word").isNotNull()).groupBy("word").agg(F.count("*").alias("cnt"))


def word_index(vocab: DataFrame) -> DataFrame:
    """Give each vocabulary word a dense id by alphabetical order.

    The vocabulary is written first: range partitioning reads its input twice,
    and counting the corpus is the costly part.
    """
    return with_position(materialize(vocab), ["word"], "word_id").select("word_id", *vocab.columns)


def tfidf_top(
    df: DataFrame, tokens: str = "tokens", n: int | None = 10, documents: DataFrame | None = None
) -> DataFrame:
    """Words by summed tf * idf, idf = ln((1+N)/(1+df)) + 1, without row norm.

    N is a row count; give the untokenized table as ``documents`` to take it
    from there without tokenizing.
    """
    n_docs = (df if documents is None else documents).agg(F.count("*")).scalar()
    idf = F.log((1.0 + n_docs) / (1.0 + F.col("df"))) + 1.0
    weights = vocabulary(df, tokens).select(
        F.col("word").alias("keyword"), F.round(F.col("cnt") * idf, 6).alias("tfidf_weight")
    )
    if n is None:
        return weights
    return weights.orderBy(F.desc("tfidf_weight"), "keyword").limit(n)
