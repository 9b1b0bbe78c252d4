"""Clean, tokenize and assign topics to comments as they arrive."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from opinionlens.functions.text import clean_text, drop_words, tokenize
from opinionlens.operators.topics import TopicModel


def enrich(comments: DataFrame, stopwords: Iterable[str] = (), topics: TopicModel | None = None) -> DataFrame:
    """Add cleaned_content, tokens, processed_content and, with a fitted model,
    dominant_topic. No step keeps state, so a streaming DataFrame is accepted.
    """
    out = comments.withColumn("cleaned_content", clean_text("content"))
    out = out.withColumn("tokens", tokenize("cleaned_content"))
    out = out.withColumn("processed_content", drop_words("tokens", sorted(set(stopwords))))
    return out if topics is None else topics.assign(out)
