"""Report requests: a group's comments as prompt and payload rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinionlens.operators.explore import hits, same_topic
from opinionlens.operators.scaling import bounded_join, with_position
from opinionlens.session import materialize

# Fixed texts of the request: task, list heading and the three sections asked for.
TASK = "结合{subject}的具体政策条例辅助分析，针对以下用户评论，进行结构化主题分析："
LIST_HEADING = "评论列表："
SECTIONS = "格式要求：\n一、主题分布\n二、主题关联性分析\n三、政策舆情分析与解读"

# Fixed request parameters.
MODEL = "glm-4"
TEMPERATURE = 0.7
TOP_P = 0.95
MAX_TOKENS = 1500


def prompt_text(comments: Column, subject: str) -> Column:
    head = f"\n{TASK.format(subject=subject)}\n{LIST_HEADING}\n"
    return F.concat(F.lit(head), F.to_json(comments), F.lit(f"\n\n{SECTIONS}\n"))


def payload_json(prompt: Column, model: str = MODEL) -> Column:
    message = F.struct(F.lit("user").alias("role"), prompt.alias("content"))
    return F.to_json(
        F.struct(
            F.lit(model).alias("model"),
            F.array(message).alias("messages"),
            F.lit(TEMPERATURE).alias("temperature"),
            F.lit(TOP_P).alias("top_p"),
            F.lit(MAX_TOKENS).alias("max_tokens"),
        )
    )


def report_requests(
    comments: DataFrame,
    subject: str,
    group: str = "dominant_topic",
    text: str = "text",
    order: Sequence[str] = ("id",),
    per_request: int = 100,
    model: str = MODEL,
) -> DataFrame:
    """(group, part, n_comments, prompt, payload): request rows to send.

    Every non-blank comment of a group appears in exactly one part, in
    ``order``, which must be unique within the group. Parts come from global
    positions, so a group with a third of all comments is cut up without ever
    passing through one task.
    """
    order = list(order)
    rows = comments.select(group, *order, text).filter(
        F.col(group).isNotNull() & (F.trim(F.coalesce(F.col(text), F.lit(""))) != "")
    )
    placed = with_position(rows, [group, *order], "position")
    starts = materialize(placed.groupBy(group).agg(F.min("position").alias("start")))
    part = F.floor((F.col("position") - F.col("start")) / per_request).cast("bigint") + 1
    parts = bounded_join(placed, starts, group, order[-1]).withColumn("part", part)
    listed = F.sort_array(F.collect_list(F.struct("position", F.trim(text).alias("text"))))
    grouped = parts.groupBy(group, "part").agg(F.count("*").alias("n_comments"), listed.alias("c"))
    return (
        grouped.withColumn("prompt", prompt_text(F.col("c.text"), subject))
        .withColumn("payload", payload_json(F.col("prompt"), model))
        .select(group, "part", "n_comments", "prompt", "payload")
    )


def search_report(
    results: DataFrame, keyword: str, subject: str, id_col: str = "id", literal: bool = False, per_request: int = 100
) -> DataFrame:
    """Requests for one search: the hits, then all comments of their topic.

    A hit is listed in both sections, as on the result page it stands for.
    """
    found = hits(results, keyword, literal).select(F.lit(0).alias("section"), id_col, "text")
    others = same_topic(results, keyword, id_col, literal).select(F.lit(1).alias("section"), id_col, "text")
    rows = found.union(others).withColumn("keyword", F.lit(keyword.strip()))
    return report_requests(rows, subject, "keyword", "text", ["section", id_col], per_request)
