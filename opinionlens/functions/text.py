"""Cleaning, tokenizing and in-row token counting."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed patterns of the cleaning rule. A tag such as "[smileR]" loses its R;
# then letters, numbers, underscore, white space and square brackets stay.
# \x1c-\x1f count as white space. The first pattern excludes "[" inside the
# tag: the innermost bracket gives the same result and keeps the scan linear.
EMOJI_TAG = r"\[([^\[\]]*)R\]"
DROPPED = r"(?U)[^\p{L}\p{N}_\s\x1c-\x1f\[\]]+"
BLANKS = r"(?U)[\s\x1c-\x1f]+"

NO_TOKENS = "cast(array() as array<string>)"


def clean_text(text: Column | str) -> Column:
    """Normalised text; null becomes the empty string."""
    c = F.col(text) if isinstance(text, str) else text
    c = F.regexp_replace(F.coalesce(c, F.lit("")), EMOJI_TAG, "[$1]")
    c = F.regexp_replace(c, DROPPED, "")
    return F.trim(F.regexp_replace(F.lower(c), BLANKS, " "))


def tokenize(cleaned: Column | str) -> Column:
    """White-space tokens of cleaned text; null and blank give an empty list."""
    c = F.col(cleaned) if isinstance(cleaned, str) else cleaned
    parts = F.split(F.coalesce(c, F.lit("")), BLANKS)
    return F.filter(parts, lambda t: t != "")


def drop_words(tokens: Column | str, words: Sequence[str], drop_blank: bool = False) -> Column:
    """Tokens outside ``words``: exact match, order and repeats kept, null tokens left out.

    ``isin`` over literals becomes one hash-set lookup per token.
    """
    c = F.col(tokens) if isinstance(tokens, str) else tokens
    words = list(words)

    def keep(t: Column) -> Column:
        out = t.isNotNull() & ~t.isin(words) if words else t.isNotNull()
        return out & (F.trim(t) != "") if drop_blank else out

    return F.filter(F.coalesce(c, F.expr(NO_TOKENS)), keep)


def join_tokens(tokens: Column | str, separator: str = "") -> Column:
    return F.array_join(tokens, separator)


def truncate_tokens(tokens: Column | str, length: int = 128) -> Column:
    return F.slice(tokens, 1, length)


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, with the value computed once per row.

    A lambda over a one-element array: an expression that is only named in a
    projection would be inlined, and computed again for every element of an
    inner lambda, as soon as a filter is pushed below the projection.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def word_counts(tokens: Column | str) -> Column:
    """array<struct<word,cnt>> of the row's tokens, in word order.

    The tokens are sorted inside the row and the run lengths read off, so
    counting words per document needs no shuffle.
    """
    c = F.col(tokens) if isinstance(tokens, str) else tokens

    def starts(s: Column) -> Column:
        changed = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))
        return F.when(F.size(s) > 0, changed).otherwise(F.expr("cast(array() as array<int>)"))

    def runs(s: Column, b: Column) -> Column:
        def one(x: Column, i: Column) -> Column:
            end = F.coalesce(F.get(b, i + 1), F.size(s))
            return F.struct(F.get(s, x).alias("word"), (end - x).cast("bigint").alias("cnt"))

        return F.transform(b, one)

    filled = F.coalesce(c, F.expr(NO_TOKENS))
    return bind(F.sort_array(filled), lambda s: bind(starts(s), lambda b: runs(s, b)))


def with_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add computed columns as generator output.

    A filter on a projected column is pushed below the projection with the
    whole expression in it, which is then computed once more. It cannot pass
    a generator, so these columns are computed exactly once per row.
    """
    names = [c for c in df.columns if c not in columns]
    row = F.struct(*[c.alias(n) for n, c in columns.items()])
    return df.select(*names, F.inline_outer(F.array(row)))


def explode_counts(df: DataFrame, *keep: Column | str, tokens: str = "tokens") -> DataFrame:
    """``keep`` columns plus (word, cnt), one row per distinct word of a row.

    The outer form, filtered afterwards: the plain one makes the optimizer
    add a non-empty test that would count every row's words a second time.
    """
    long = df.select(*keep, F.inline_outer(word_counts(tokens)).alias("word", "cnt"))
    return long.filter(F.col("word").isNotNull())


def frequent_words(bag: Column | str, n: int) -> Column:
    """The ``n`` most frequent words of a bag; equal counts by word."""
    ranked = F.sort_array(F.transform(bag, lambda r: F.struct((-r["cnt"]).alias("k"), r["word"].alias("word"))))
    return F.transform(F.slice(ranked, 1, n), lambda r: r["word"])
