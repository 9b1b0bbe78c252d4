"""Quality rules: counts, guards and divergence on small rows."""

import math
import random

from opinionlens.llm.q_quality import COLUMNS
from opinionlens.llm.quality import quality_rules


def words_text(n, word="w"):
    return " ".join(f"{word}{i}" for i in range(n))


def english(n, seed=0):
    r = random.Random(seed)
    common = "the of and to in a is that for it was with".split()
    plain = lambda: "".join(r.choice("etaoinshrdlu") for _ in range(r.randrange(3, 9)))
    return " ".join(r.choice(common) if i % 3 == 0 else plain() for i in range(n))


def judged(spark, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, n_words int")
    return {(r.doc_id, r.text): r for r in quality_rules(df).collect()}


def test_counts(spark):
    text = "a b c a b c\n\n x#| $y \n x#| $y \nÄé\x0bend"
    (row,) = judged(spark, [(1, text, "en", 9)]).values()
    assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines) == (12, 6 + 10 + 5, 6, 1)
    assert row.n_repeat_words == 6  # a b c, twice
    assert row.base_failed and not row.kept and row.lang == "en"


def test_nulls_repeats_and_empty_table(spark):
    rows = [(1, None, None, 1), (2, "", "en", 1), (None, english(90), None, 1), (3, english(90, 1), "en", 1)]
    got = judged(spark, rows)
    assert [r.n_words for r in got.values()].count(0) == 2
    assert sorted((str(r.doc_id), r.kept) for r in got.values()) == [("1", False), ("2", False), ("3", True), ("None", True)]
    df = spark.createDataFrame([(3, english(90), "en")] * 2, "doc_id bigint, text string, lang string")
    assert quality_rules(df).count() == 2 and quality_rules(df.limit(0)).collect() == []
    assert set(COLUMNS) <= set(quality_rules(df.limit(0)).columns)


def test_divergence(spark):
    rows = [(i, english(200, i), "en", 0) for i in range(10)]
    rows += [(90, " ".join(w + "$$$" for w in english(200).split()), "en", 0), (91, words_text(200).upper() + " OK", "en", 0)]
    rows += [(92, "@#%&" * 2 + " " + english(40, 3), "en", 0)]  # too short for a distance, and for the base rules
    got = {r.doc_id: r.kept for r in judged(spark, rows).values()}
    assert got == {i: True for i in range(10)} | {90: False, 91: False, 92: False}


def test_distance_formula(spark):
    from pyspark.sql import functions as F

    from opinionlens.llm.quality import js_distance

    df = spark.createDataFrame([([3, 1, 0],), ([0, 0, 0],)], "h array<bigint>")
    got = [r[0] for r in df.select(js_distance(F.col("h"), [0.25, 0.25, 0.5])).collect()]
    p, q = [0.75, 0.25, 0], [0.25, 0.25, 0.5]
    m = [(a + b) / 2 for a, b in zip(p, q)]
    kl = lambda x: sum(a * math.log2(a / c) for a, c in zip(x, m) if a)
    assert abs(got[0] - math.sqrt((kl(p) + kl(q)) / 2)) < 1e-12 and got[1] is None
