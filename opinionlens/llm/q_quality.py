"""Query and SQL of the quality rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from opinionlens.llm.common import read_table
from opinionlens.llm.quality import CHAR_CLASSES, COMMON_WORDS, VOCABULARY, QualityRules, quality_rules

COLUMNS = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op1_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality_rules(read_table(spark, sf, "documents").select("doc_id", "text", "lang")).select(*COLUMNS)


def _divergence(own: list[str], total: str, reference: list[str]) -> str:
    parts = []
    for x, q in zip(own, reference, strict=True):
        p = f"({x}::DOUBLE / {total})"
        parts.append(
            f"(CASE WHEN {x} > 0 THEN {p} * log2({p} / (({p} + {q}) / 2)) ELSE 0 END"
            f" + CASE WHEN {q} > 0 THEN {q} * log2({q} / (({p} + {q}) / 2)) ELSE 0 END) / 2"
        )
    return f"sqrt(greatest({' + '.join(parts)}, 0))"


def quality_ctes(rules: QualityRules | None = None) -> str:
    """Common table expressions that end in ``judged``, over ``documents``."""
    r = rules or QualityRules()
    hit = {w: f"h{i}" for i, w in enumerate(VOCABULARY)}
    n_class = len(CHAR_CLASSES)
    rest = ["t"]
    for one in CHAR_CLASSES:
        rest.append(f"regexp_replace({rest[-1]}, '{one.replace(chr(92) * 2, chr(92))}', '', 'g')")
    classes = ", ".join(f"length({rest[i]}) - length({rest[i + 1]}) AS c{i}" for i in range(n_class))
    hits = ", ".join(f"len(list_filter(w, lambda x: x = '{w}')) AS {h}" for w, h in hit.items())
    other = {lang: f"(n_words - {' - '.join(hit[w] for w in ws)})" for lang, ws in COMMON_WORDS.items()}
    sums, fits = [], []
    for lang, ws in COMMON_WORDS.items():
        bins = [*(hit[w] for w in ws), other[lang]]
        mine = f"FILTER (WHERE lang = '{lang}')"
        sums += [f"sum(c{i}) {mine} / sum(n_chars) {mine} AS {lang}_c{i}" for i in range(n_class + 1)]
        sums += [f"sum({b}) {mine} / sum(n_words) {mine} AS {lang}_w{i}" for i, b in enumerate(bins)]
        chars = _divergence([f"c{i}" for i in range(n_class + 1)], "n_chars", [f"{lang}_c{i}" for i in range(n_class + 1)])
        words = _divergence(bins, "n_words", [f"{lang}_w{i}" for i in range(len(bins))])
        fits.append(
            f"coalesce((n_chars < {r.char_guard} OR {chars} <= {r.max_char_distance})"
            f" AND (n_words < {r.word_guard} OR {words} <= {r.max_word_distance}) AND {lang}_w0 IS NOT NULL, false)"
        )
    return f"""q_base AS (SELECT *, coalesce(text, '') AS t,
          regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
        q_counts AS (SELECT *, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
            length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
            list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls,
            {classes}, length({rest[-1]}) AS c{n_class}, length(t) AS n_chars,
            row_number() OVER () AS q_row
          FROM q_base),
        q_hits AS (SELECT *, len(ls) - len(list_distinct(ls)) AS n_dup_lines, {hits} FROM q_counts),
        q_windows AS (SELECT q_row, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
          FROM (SELECT q_row, w, unnest(range(1, len(w) - 1)) AS i FROM q_counts)),
        q_twice AS (SELECT q_row, i FROM (SELECT *, count(*) OVER (PARTITION BY q_row, g) AS c FROM q_windows) WHERE c > 1),
        q_covered AS (SELECT q_row, count(DISTINCT i + d) AS n FROM q_twice, (SELECT unnest([0, 1, 2]) AS d) GROUP BY q_row),
        q_measured AS (SELECT h.*, coalesce(n, 0) AS n_repeat_words,
            n_words < {r.min_words} OR 100 * coalesce(n, 0) > {r.max_repeat_percent} * n_words AS base_failed
          FROM q_hits h LEFT JOIN q_covered USING (q_row)),
        q_refs AS (SELECT {", ".join(sums)}, count(*) FILTER (WHERE lang IN ({", ".join(f"'{x}'" for x in COMMON_WORDS)})) AS n_ref
          FROM q_measured WHERE NOT base_failed),
        judged AS (SELECT m.*, NOT base_failed AND (n_ref = 0 OR {" OR ".join(fits)}) AS kept FROM q_measured m, q_refs)"""


ORACLE = f"WITH {quality_ctes()} SELECT {', '.join(COLUMNS)} FROM judged"
