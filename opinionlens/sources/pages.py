"""Article records from raw HTML pages."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from opinionlens.functions.text import bind

MISSING = "N/A"

# Private marks for "markup was here" and "next list item".
MARK, LIST_MARK = "\u0001", "\u0002"

# Fixed entities decoded by built-in expressions; & must come last.
ENTITIES = {
    "&lt;": "<",
    "&gt;": ">",
    "&quot;": '"',
    "&apos;": "'",
    "&#39;": "'",
    "&nbsp;": " ",
    "&copy;": "©",
    "&middot;": "·",
    "&amp;": "&",
}
_COMMON = "|".join(re.escape(e[1:]) for e in ENTITIES)
OTHER_ENTITY = rf"&(?!(?:{_COMMON}))[#a-zA-Z]"

# Parts whose content is not markup: comments, scripts, styles.
RAW_PARTS = r"(?is)<!--.*?-->|<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>"
TAGS = r"(?i)</?[a-z][^>]*>|<![^>]*>"
EDGE_BLANKS = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


@dataclass(frozen=True)
class Selector:
    """An element by tag name and, optionally, one attribute value.

    For ``class`` the value must be one of the element's classes, or all of
    its class text.
    """

    tag: str
    attribute: str | None = None
    value: str | None = None

    def opening(self) -> str:
        if self.attribute is None:
            return rf"(?is)<{self.tag}(?:\s[^>]*)?>"
        inner = re.escape(self.value or "")
        if self.attribute == "class":
            inner = rf"(?:[^\"'>]*\s)?{inner}(?:\s[^\"'>]*)?"
        return rf"(?is)<{self.tag}\s(?:[^>]*\s)?{self.attribute}\s*=\s*[\"']?{inner}(?:[\"'][^>]*|\s[^>]*)?>"


# Fixed element names of the article pages this was made for.
@dataclass(frozen=True)
class ArticleSelectors:
    body: Selector = Selector("div", "id", "js_content")
    title: Selector = Selector("h2", "class", "rich_media_title")
    comments: Selector = Selector("div", "class", "rich_media_comment_list")
    comment: Selector = Selector("li", "class", "comment_item")
    comment_text: Selector | None = field(default=Selector("span", "class", "comment_content"))
    time: Selector = Selector("em", "id", "post-date")
    place: Selector = Selector("a", "class", "rich_media_meta rich_media_meta_link rich_media_meta_nickname")
    source: Selector = Selector("a", "class", "rich_media_meta rich_media_meta_link rich_media_meta_nickname")


@F.pandas_udf(StringType())
def _unescape(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else html.unescape(t))


def decode_entities(text: Column) -> Column:
    """Decode HTML entities; only rows with uncommon ones visit Python."""
    simple = text
    for entity, char in ENTITIES.items():
        simple = F.replace(simple, F.lit(entity), F.lit(char))
    rare = F.rlike(text, F.lit(OTHER_ENTITY))
    return F.when(rare, _unescape(F.when(rare, text))).otherwise(simple)


def balanced_inner(page: Column, selector: Selector) -> Column:
    """Markup inside the first matching element, nested same-name tags included.

    The text after the opening tag is cut before each tag of that name and
    the depth followed to where the element closes; an element that never
    closes reaches to the end. No match gives null.
    """
    opening, tag = F.lit(selector.opening()), selector.tag
    start = F.regexp_instr(page, opening)
    rest = F.substr(page, start + F.length(F.regexp_substr(page, opening)))
    pieces = F.split(rest, rf"(?i)(?=</?{tag}[\s/>])")

    def step(state: Column, piece: Column) -> Column:
        move = (
            F.when(F.rlike(piece, F.lit(rf"(?i)^<{tag}[\s/>]")), F.lit(1))
            .when(F.rlike(piece, F.lit(rf"(?i)^</{tag}[\s/>]")), F.lit(-1))
            .otherwise(F.lit(0))
        )
        depth = F.when(state["depth"] > 0, state["depth"] + move).otherwise(F.lit(0))
        kept = F.when(depth > 0, state["kept"] + 1).otherwise(state["kept"])
        return F.struct(depth.alias("depth"), kept.alias("kept"))

    def inside(p: Column) -> Column:
        kept = F.aggregate(p, F.struct(F.lit(1).alias("depth"), F.lit(0).alias("kept")), step, lambda s: s["kept"])
        return F.array_join(F.slice(p, F.lit(1), kept), "")

    return F.when(start > 0, bind(pieces, inside))


def mark_raw_parts(page: Column) -> Column:
    """Put a mark in place of everything that is neither text nor a tag."""
    return F.regexp_replace(F.translate(page, MARK + LIST_MARK, "  "), RAW_PARTS, MARK)


def mark_tags(markup: Column) -> Column:
    return F.regexp_replace(markup, TAGS, MARK)


def joined_nodes(marked: Column) -> Column:
    """Text nodes on lines of their own, outer white space trimmed."""
    return F.regexp_replace(F.regexp_replace(marked, MARK + "+", "\n"), EDGE_BLANKS, "")


def stripped_nodes(marked: Column) -> Column:
    """Text nodes trimmed one by one and joined without a separator."""
    tight = F.regexp_replace(marked, rf"(?U)[\s\x1c-\x1f]*{MARK}[\s\x1c-\x1f{MARK}]*", "")
    return F.regexp_replace(tight, EDGE_BLANKS, "")


def _items(container: Column, selectors: ArticleSelectors) -> Column:
    """Marked comment texts, each after a list mark; no comments give ''."""
    item = selectors.comment.opening() + rf"(.*?)(?:</{selectors.comment.tag}\s*>|$)"
    found = F.regexp_extract_all(container, F.lit(item), F.lit(1))

    def text(markup: Column) -> Column:
        inner = markup if selectors.comment_text is None else balanced_inner(markup, selectors.comment_text)
        return mark_tags(F.coalesce(inner, F.lit("")))

    listed = F.concat(F.array(F.lit("")), F.transform(found, text))
    return F.coalesce(F.array_join(listed, LIST_MARK), F.lit(""))


def extract_articles(
    pages: DataFrame, selectors: ArticleSelectors | None = None, page: str = "html", keys: tuple[str, ...] = ("page_id", "url")
) -> tuple[DataFrame, DataFrame]:
    """Article records, and the pages that gave none with the reason.

    A page counts when it has both the body and the title element. Absent
    time, place or source become "N/A". All steps are row-local; each is its
    own projection so that no expression is evaluated twice.
    """
    sel = selectors or ArticleSelectors()
    single = {"content": sel.body, "title": sel.title, "time": sel.time, "place": sel.place, "source": sel.source}

    def cut(p: Column) -> Column:
        fields = [balanced_inner(p, s).alias(name) for name, s in single.items()]
        return F.struct(*fields, balanced_inner(p, sel.comments).alias("comments"))

    # As generator output the fields cannot be inlined into the filters below.
    raw = pages.select(*keys, F.inline_outer(F.transform(F.array(mark_raw_parts(F.col(page))), cut)))
    reason = F.when(F.col("content").isNull(), "no body").when(F.col("title").isNull(), "no title")
    raw = raw.withColumn("reason", reason)
    rejects = raw.filter(F.col("reason").isNotNull()).select(*keys, "reason")
    good = raw.filter(F.col("reason").isNull())
    marked = good.select(
        *keys, *[mark_tags(F.col(n)).alias(n) for n in single], _items(F.col("comments"), sel).alias("comments")
    )
    plain = marked.select(*keys, *[decode_entities(F.col(n)).alias(n) for n in (*single, "comments")])

    def field_or_missing(name: str) -> Column:
        return F.coalesce(stripped_nodes(F.col(name)), F.lit(MISSING)).alias(name)

    listed = F.split("comments", LIST_MARK)
    comments = F.transform(F.slice(listed, F.lit(2), F.size(listed)), stripped_nodes)
    articles = plain.select(
        *keys,
        stripped_nodes(F.col("title")).alias("title"),
        field_or_missing("time"),
        field_or_missing("place"),
        joined_nodes(F.col("content")).alias("content"),
        field_or_missing("source"),
        comments.alias("comments"),
    )
    return articles, rejects


def article_rows(articles: DataFrame) -> DataFrame:
    """Flat record for a CSV sink: comments joined by line breaks."""
    return articles.select(
        F.col("time").alias("Time"),
        F.col("place").alias("Place"),
        F.col("content").alias("Content"),
        F.col("source").alias("Source"),
        F.array_join("comments", "\n").alias("Comments"),
    )
