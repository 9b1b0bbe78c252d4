"""Overview, search and drill-down over the result table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinionlens.functions.matching import contains_keyword

KEYWORD_COLUMNS = ("keyword1", "keyword2", "keyword3")

# Fixed columns of a search result.
RESULT_COLUMNS = (
    "cut_content",
    "text",
    "keyword1",
    "keyword2",
    "keyword3",
    "similarity_score",
    "processed_content",
    "dominant_topic",
    "sentiment_score",
    "sentiment_label",
)

# Fixed result texts of the search summary.
FOUND = "搜索关键词 '{keyword}' 共找到 {total} 条评论，其中正面评论 {positive} 条，中性评论 {neutral} 条，负面评论 {negative} 条。"
NOT_FOUND = "未找到与关键词 '{keyword}' 相关的评论。"


def hot_keywords(
    results: DataFrame,
    columns: Sequence[str] = KEYWORD_COLUMNS,
    n: int | None = 20,
    drop_null: bool = False,
) -> DataFrame:
    """Keywords by how many of the keyword cells hold them, most used first.

    One scan explodes the columns; counting is partial before the shuffle.
    Missing cells form a group of their own unless ``drop_null``.
    """
    cells = results.select(F.explode(F.array(*columns)).alias("keyword"))
    if drop_null:
        cells = cells.filter(F.col("keyword").isNotNull())
    counts = cells.groupBy("keyword").agg(F.count("*").alias("count"))
    if n is None:
        return counts
    return counts.orderBy(F.desc("count"), F.asc_nulls_last("keyword")).limit(n)


def sample_comments(results: DataFrame, n: int = 10, id_col: str = "id", column: str = "cut_content") -> DataFrame:
    return results.orderBy(id_col).limit(n).select(id_col, column)


def overview(results: DataFrame, n_comments: int = 10, n_keywords: int = 20) -> tuple[DataFrame, DataFrame]:
    """First comments and hot keywords of the whole table."""
    return sample_comments(results, n_comments), hot_keywords(results, n=n_keywords)


def search(
    results: DataFrame,
    keyword: str,
    literal: bool = False,
    columns: Sequence[str] = ("text", *KEYWORD_COLUMNS),
) -> DataFrame:
    """The ten result columns of rows whose text or any keyword contains the keyword; a pure filter."""
    return hits(results, keyword, literal, columns).select(*RESULT_COLUMNS)


def hits(
    results: DataFrame,
    keyword: str,
    literal: bool = False,
    columns: Sequence[str] = ("text", *KEYWORD_COLUMNS),
) -> DataFrame:
    """All columns of the rows that a search finds."""
    return results.filter(contains_keyword(columns, keyword, literal))


def same_topic(
    results: DataFrame,
    keyword: str,
    id_col: str = "id",
    literal: bool = False,
    exclude_hits: bool = False,
    candidates: DataFrame | None = None,
) -> DataFrame:
    """All rows of the topic of the first hit, the hits included by default.

    The first hit is looked for in ``candidates`` where a search index gives
    them, else in all rows. The first hit is one row by construction, so its broadcast is bounded;
    on a table partitioned by topic it also prunes the other partitions.
    """
    first = hits(results if candidates is None else candidates, keyword, literal).agg(F.min_by("dominant_topic", id_col).alias("dominant_topic"))
    out = results
    if exclude_hits:
        hit = contains_keyword(("text", *KEYWORD_COLUMNS), keyword, literal)
        out = out.filter(~F.coalesce(hit, F.lit(False)))
    return out.join(F.broadcast(first), "dominant_topic", "left_semi")


def _fill(template: str, **values: Column) -> Column:
    """Replace each {name} of the template by a column."""
    parts, rest = [], template
    while "{" in rest:
        text, rest = rest.split("{", 1)
        name, rest = rest.split("}", 1)
        parts += [F.lit(text), values[name].cast("string")]
    return F.concat(*parts, F.lit(rest))


def search_summary(results: DataFrame, keyword: str, literal: bool = False) -> DataFrame:
    """One row of counts by label and the sentence that reports them."""
    label = F.col("sentiment_label")
    counts = hits(results, keyword, literal).agg(
        F.count("*").alias("total_comments"),
        F.count_if(label == "Positive").alias("positive"),
        F.count_if(label == "Neutral").alias("neutral"),
        F.count_if(label == "Negative").alias("negative"),
    )
    shown = F.lit(keyword.strip())
    found = _fill(
        FOUND,
        keyword=shown,
        total=F.col("total_comments"),
        positive=F.col("positive"),
        neutral=F.col("neutral"),
        negative=F.col("negative"),
    )
    sentence = F.when(F.col("total_comments") > 0, found).otherwise(_fill(NOT_FOUND, keyword=shown))
    return counts.withColumn("api_summary", sentence)
