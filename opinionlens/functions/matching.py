"""Substring search with the case rule of an ASCII-only LIKE."""

from __future__ import annotations

import string
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def fold_ascii(c: Column) -> Column:
    """Lowercase A-Z only; accented letters keep their case."""
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def fold_keyword(keyword: str) -> str:
    """The trimmed keyword, folded like the columns."""
    return "".join(ch.lower() if ch in string.ascii_uppercase else ch for ch in keyword.strip())


def contains_keyword(columns: Sequence[str], keyword: str, literal: bool = False) -> Column:
    """True where any column holds the trimmed keyword; null where none can tell.

    By default ``%`` and ``_`` inside the keyword are wildcards and there is
    no escape character; ``literal=True`` takes the keyword as plain text.
    A blank keyword matches every row with at least one non-null column.
    """
    folded = fold_keyword(keyword)
    if literal:
        hits = [F.contains(fold_ascii(F.col(c)), F.lit(folded)) for c in columns]
    else:
        pattern = "%" + folded.replace("\\", "\\\\") + "%"
        hits = [fold_ascii(F.col(c)).like(pattern) for c in columns]
    return reduce(lambda a, b: a | b, hits)
