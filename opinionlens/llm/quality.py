"""Quality rules by distribution divergence, in built-in expressions only.

A document's histograms of character classes and of common words are compared
with those of each language by Jensen-Shannon distance. The language references
are summed from all documents that pass the base rules and name the language.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinionlens.functions.text import with_once
from opinionlens.session import materialize

# Common words of each language, and character classes as regular expressions.
COMMON_WORDS = {
    "en": ("the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "was", "with"),
    "fr": ("le", "la", "les", "de", "des", "et", "en", "du", "un", "que", "dans", "est"),
    "de": ("der", "die", "und", "den", "das", "von", "zu", "mit", "sich", "ist", "im", "nicht"),
    "es": ("el", "la", "los", "de", "que", "y", "en", "las", "un", "por", "con", "no"),
}
SPACES = "[\\x20\\x09-\\x0D]+"
CHAR_CLASSES = ("[a-z]+", "[A-Z]+", "[0-9]+", SPACES, "[!-/:-@\\[-`{-~]+", "\\p{L}+")

VOCABULARY = sorted({w for words in COMMON_WORDS.values() for w in words})
WORD = "[^\\x20\\x09-\\x0D]+"
SYMBOLS = "[#*$%&|<>]+"


@dataclass(frozen=True)
class QualityRules:
    min_words: int = 50
    #: Highest share, in per cent, of words in 3-word windows found twice or more.
    max_repeat_percent: int = 50
    #: A distance counts only in texts of so many characters or words.
    char_guard: int = 300
    word_guard: int = 100
    max_char_distance: float = 0.26
    max_word_distance: float = 0.285


def _count(before: Column, after: Column) -> Column:
    return (F.char_length(before) - F.char_length(after)).cast("long")


def _repeat_words(windows: Column) -> Column:
    """Words covered by windows found twice or more.

    Windows are sorted with their places; those equal to a neighbour are found
    twice. Each of them covers the words up to the next one, three at most.
    """
    placed = F.array_sort(F.transform(windows, lambda w, i: F.struct(w.alias("w"), i.alias("i"))))

    def twice(all_: Column) -> Column:
        same = lambda x, y: F.coalesce(x["w"] == y["w"], F.lit(False))
        found = F.filter(all_, lambda x, i: same(x, F.get(all_, i - 1)) | same(x, F.get(all_, i + 1)))
        return F.sort_array(F.transform(found, lambda x: x["i"]))

    def covered(at: Column) -> Column:
        gaps = F.transform(at, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1) - x, F.lit(3))))
        return F.aggregate(gaps, F.lit(0), lambda total, gap: total + gap)

    # A one-element transform binds its argument once, where a plain reuse would compute it at each use.
    once = lambda value, f: F.transform(F.array(value), f)[0]
    return once(placed, lambda p: once(twice(p), covered)).cast("long")


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add counts and histograms of each whole text (null: no words)."""
    blank = F.coalesce(F.col(text), F.lit(""))
    for other in "\t\n\x0b\x0c\r":
        blank = F.replace(blank, F.lit(other), F.lit(" "))
    out = with_once(docs, __text=F.coalesce(F.col(text), F.lit("")), __words=F.array_remove(F.split(blank, " "), ""))
    n = F.size("__words")
    starts = F.slice("__words", 1, F.greatest(n - 2, F.lit(0)))
    follow = lambda i, k: F.get("__words", i + k)
    hashes = F.transform(starts, lambda w, i: F.xxhash64(w, follow(i, 1), follow(i, 2)))
    windows = F.transform(starts, lambda w, i: F.concat_ws(" ", w, follow(i, 1), follow(i, 2)))
    lines = F.filter(F.split("__text", "\n"), lambda line: line.rlike(WORD))
    common = F.filter("__words", lambda w: w.isin(VOCABULARY))
    out = with_once(out, __hashes=hashes, __lines=lines, __common=common)
    rest = ["__text", *[f"__rest{i}" for i in range(len(CHAR_CLASSES))]]
    for i, one in enumerate(CHAR_CLASSES):
        out = with_once(out, **{rest[i + 1]: F.regexp_replace(rest[i], one, "")})
    by_class = [_count(F.col(x), F.col(y)) for x, y in zip(rest, rest[1:])]
    size = F.size("__common")
    hits = [(size - F.size(F.array_remove("__common", w))).cast("long") for w in VOCABULARY]
    out = with_once(
        out,
        **{
            "n_words": n.cast("long"),
            "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
            # Windows with different hashes differ; only where a hash repeats are the words themselves compared.
            "n_repeat_words": F.when(
                F.size(F.array_distinct("__hashes")) == F.size("__hashes"), F.lit(0).cast("long")
            ).otherwise(_repeat_words(windows)),
            "n_symbols": _count(F.col(rest[1]), F.regexp_replace(rest[1], SYMBOLS, "")),
            "hist_chars": F.array(*by_class, F.char_length(rest[-1]).cast("long")),
            "__hits": F.array(*hits),
        },
    )
    by_language = {}
    for lang, ws in COMMON_WORDS.items():
        mine = [F.get("__hits", F.lit(VOCABULARY.index(w))) for w in ws]
        by_language[f"hist_{lang}"] = F.array(*mine, F.col("n_words") - sum(mine))
    word_chars = F.char_length("__text") - F.get("hist_chars", F.lit(CHAR_CLASSES.index(SPACES)))
    out = out.withColumns(by_language | {"word_chars": word_chars.cast("long")})
    return out.drop("__words", "__hashes", "__lines", "__common", "__hits", *rest)


def base_failed(rules: QualityRules) -> Column:
    return (F.col("n_words") < rules.min_words) | (100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words"))


def language_references(measured: DataFrame, rules: QualityRules, lang: str = "lang") -> dict[str, tuple[list, list]]:
    """Character and word shares of each language, over all its documents that pass the base rules.

    One row for each language of ``COMMON_WORDS`` reaches the driver.
    """
    sums = [F.sum(F.get("hist_chars", F.lit(i))).alias(f"c{i}") for i in range(len(CHAR_CLASSES) + 1)]
    for name, ws in COMMON_WORDS.items():
        mine = F.when(F.col(lang) == name, F.col(f"hist_{name}"))
        sums += [F.sum(F.get(mine, F.lit(i))).alias(f"{name}{i}") for i in range(len(ws) + 1)]
    good = measured.filter(~base_failed(rules) & F.col(lang).isin(*COMMON_WORDS))
    found = {}
    for row in good.groupBy(lang).agg(*sums).collect():
        name = row[lang]
        chars = [row[f"c{i}"] for i in range(len(CHAR_CLASSES) + 1)]
        words = [row[f"{name}{i}"] for i in range(len(COMMON_WORDS[name]) + 1)]
        found[name] = [x / sum(chars) for x in chars], [x / sum(words) for x in words]
    return found


def js_distance(counts: Column, shares: list[float]) -> Column:
    """Jensen-Shannon distance (base 2, 0 to 1) of a histogram from reference shares; null for an empty one."""
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x)

    def part(p: Column, q: float) -> Column:
        middle = (p + F.lit(q)) / 2
        left = F.when(p > 0, p * F.log2(p / middle)).otherwise(0.0)
        right = F.lit(q) * F.log2(F.lit(q) / middle) if q > 0 else F.lit(0.0)
        return (left + right) / 2

    terms = sum(part(F.get(counts, F.lit(i)) / total, q) for i, q in enumerate(shares))
    return F.when(total > 0, F.sqrt(F.greatest(terms, F.lit(0.0))))


def judge(measured: DataFrame, references: dict[str, tuple[list, list]], rules: QualityRules) -> DataFrame:
    """Add ``base_failed`` and ``kept``.

    A document is kept if it passes the base rules and fits one language at
    least: both distances are within their limits, or the text is shorter than
    the guard of that distance. Without references the base rules decide.
    """
    n_chars = F.aggregate("hist_chars", F.lit(0).cast("long"), lambda a, x: a + x)
    fits = F.lit(not references)
    for name, (chars, words) in sorted(references.items()):
        by_char = (n_chars < rules.char_guard) | (js_distance(F.col("hist_chars"), chars) <= rules.max_char_distance)
        by_word = (F.col("n_words") < rules.word_guard) | (js_distance(F.col(f"hist_{name}"), words) <= rules.max_word_distance)
        fits = fits | (by_char & by_word)
    failed = base_failed(rules)
    return measured.withColumns({"base_failed": failed, "kept": ~failed & F.coalesce(fits, F.lit(False))})


def quality_rules(docs: DataFrame, rules: QualityRules | None = None, text: str = "text", lang: str = "lang") -> DataFrame:
    """Judge every row of ``docs``; all its columns stay, and counts, ``base_failed`` and ``kept`` are added.

    Null and empty texts have no words and fail. Each repeated row is judged.
    Rows whose language is null or has no reference are judged by the others'
    references. An empty table gives an empty one. Columns of ``docs`` that are
    named like an added one are replaced; names with two leading underscores
    are the operator's own.
    """
    rules = rules or QualityRules()
    measured = materialize(measure(docs, text))
    judged = judge(measured, language_references(measured, rules, lang), rules)
    return judged.drop("hist_chars", *[f"hist_{name}" for name in COMMON_WORDS])
