"""Post and comment collections: flatten, cap per source, select by topic."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from opinionlens.operators.scaling import bounded_join
from opinionlens.session import materialize


def post_comment_pairs(
    posts: DataFrame,
    comments: DataFrame,
    post_id: str = "post_id",
    position: str = "pos",
    max_posts: int | None = 5,
    max_comments: int | None = 20,
) -> DataFrame:
    """(post_id, post_text, pos, comment): first comments of the first posts.

    ``posts`` has (post_id, post_text), ``comments`` (post_id, pos, comment).
    The rank filter is also applied before the shuffle, so a post with very
    many comments sends at most ``max_comments`` rows per task.
    """
    if max_posts is not None:
        posts = posts.orderBy(post_id).limit(max_posts)
        comments = comments.join(F.broadcast(posts.select(post_id)), post_id, "left_semi")
    if max_comments is not None:
        rank = F.row_number().over(W.partitionBy(post_id).orderBy(position))
        comments = comments.withColumn("__rank", rank).filter(F.col("__rank") <= max_comments).drop("__rank")
        pairs = posts.join(comments, post_id)
    else:
        # Without a cap one post may hold a large share of all comments.
        pairs = bounded_join(comments, materialize(posts.withColumn("__found", F.lit(True))), post_id, position)
        pairs = pairs.filter(F.col("__found"))
    return pairs.select(post_id, "post_text", position, "comment")


def cap_per_source(
    df: DataFrame, source: str = "source", order: str = "doc_id", per_page: int = 15, max_pages: int = 2
) -> DataFrame:
    """First pages of each source; adds page and place on the page, from 1."""
    rank = F.row_number().over(W.partitionBy(source).orderBy(order))
    ranked = df.withColumn("__rank", rank).filter(F.col("__rank") <= per_page * max_pages)
    page = F.floor((F.col("__rank") - 1) / per_page).cast("int") + 1
    place = (F.col("__rank") - 1) % per_page + 1
    return ranked.withColumn("page", page).withColumn("place", place).drop("__rank")


def collect_by_keyword(df: DataFrame, keyword: str, text: str = "text") -> DataFrame:
    """Rows that mention the keyword; possibly none."""
    return df.filter(F.contains(F.col(text), F.lit(keyword)))
