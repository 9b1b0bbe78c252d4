"""Cross-parsing against a plain search, and held-out accuracy."""

import math
import random

import pytest
from pyspark.sql import functions as F

from opinionlens.llm import langid
from opinionlens.llm.langid import CrossParser, LanguageSamples, identify_languages, sample_languages


def plain_phrases(parser, text, sample):
    """Longest matches by searching the codes of the sample as characters."""
    codes, learned = ("".join(map(chr, parser.encode(x))) for x in (text, sample))
    count, start, i = 1 if codes else 0, 0, 0
    while i < len(codes):
        if codes[start : i + 1] in learned:
            i += 1
            continue
        count += 1
        start = i
        if codes[i] not in learned:
            i += 1
            start = i
    return count


def samples():
    r = random.Random(2)
    make = lambda syllables, n: " ".join("".join(r.choices(syllables, k=r.randrange(1, 4))) for _ in range(n))
    kinds = {"aa": ["ta", "ke", "lo"], "bb": ["zu", "shé", "ri", "ta"], "cc": ["日", "本語", "か"]}
    return kinds, make


@pytest.mark.parametrize("dense_bytes", [0, 128 << 20])
def test_phrases_match_plain_search(monkeypatch, dense_bytes):
    """Transitions as an array and as a hash table."""
    monkeypatch.setattr(langid, "DENSE_BYTES", dense_bytes)
    kinds, make = samples()
    learned = LanguageSamples(tuple((k, make(s, 300)) for k, s in kinds.items()))
    parser = CrossParser(learned.texts)
    texts = [make(kinds["aa"], 700), make(kinds["bb"], 40), "Ω Ω!! 12 🙂", "", "TA ke. lo", make(kinds["cc"], 90) + " x" * 600]
    texts += [learned.texts[1][1] * 3, make(kinds["bb"], 5000), learned.texts[0][1][5:700] + "Ω" + learned.texts[2][1]]
    got, letters = parser.phrases(texts)
    for row, (_, sample) in enumerate(learned.texts):
        for i, text in enumerate(texts):
            if text:
                assert got[row, i] == plain_phrases(parser, text, sample), (row, i)
    assert letters[3] == 0 and letters[4] == 6


def test_accuracy_and_edge_cases(spark):
    kinds, make = samples()
    rows = [(i, make(kinds[k], 25), k, "x") for i, k in enumerate(["aa", "bb", "cc"] * 60)]
    rows += [(900, None, "aa", "x"), (901, "", None, "x"), (902, "12 ?!", "bb", "x"), (None, "take lo", None, "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score string").repartition(3)
    learned = sample_languages(df, F.col("doc_id") % 4 != 2)
    got = identify_languages(df, learned).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.doc_id is not None and r.doc_id < 900 and r.doc_id % 4 == 2]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)
    assert {r.lang_pred for r in got if r.doc_id in (900, 901, 902)} == {"und"}
    assert identify_languages(df.limit(0), learned).collect() == []
    nothing = sample_languages(df.limit(0), F.lit(True))
    assert {(r.lang_pred, r.score) for r in identify_languages(df, nothing).collect()} == {("und", 0.0)}


def test_weights_follow_the_length_of_what_was_learned():
    parser = CrossParser((("a", "ab" * 500), ("b", "ab")))
    assert math.isclose(parser.weights[0], math.log2(1000)) and parser.weights[1] == 1.0


def test_large_alphabets(spark):
    """Two languages of a thousand letters each, none shared, beside two of Latin letters."""
    r = random.Random(5)
    signs = {"han1": [chr(0x4E00 + i) for i in range(1000)], "han2": [chr(0x6000 + i) for i in range(1000)]}
    kinds = signs | {"aa": ["ta", "ke", "lo"], "bb": ["zu", "shé", "ri", "ta"]}
    rows = [(i, "".join(r.choices(kinds[k], k=60)) + "。" + "".join(r.choices(kinds[k], k=60)), k) for i, k in enumerate(list(kinds) * 60)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    got = identify_languages(df, sample_languages(df, F.col("doc_id") % 5 != 2)).filter("doc_id % 5 = 2").collect()
    assert sum(x.lang == x.lang_pred for x in got) >= 0.95 * len(got)


def test_ties_repeated_rows_and_very_long_texts(spark):
    learned = LanguageSamples((("x", "same text"), ("y", "same text")))
    rows = [(1, "same text"), (1, "same text"), (2, "text same " * 60_000)]
    got = identify_languages(spark.createDataFrame(rows, "doc_id bigint, text string"), learned).collect()
    assert [r.lang_pred for r in got] == ["x"] * 3 and {r.score for r in got} == {0.0}
