import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from opinionlens.functions.ranking import dominant_index, sentiment_label
from opinionlens.operators import scaling, sentiment
from opinionlens.operators.sentiment import fit_sentiment, sentiment_box, sentiment_by_topic, sentiment_outliers


def test_label_bounds(spark):
    rows = [(0.6,), (0.4,), (0.5,), (0.59999,), (None,), (float("nan"),)]
    got = [r[0] for r in spark.createDataFrame(rows, "s double").select(sentiment_label("s")).collect()]
    assert got == ["Positive", "Negative", "Neutral", "Neutral", "Neutral", "Neutral"]


def test_dominant_index(spark):
    rows = [([0.1, 0.4, 0.4, 0.1],), ([0.0] * 4,), ([],), (None,)]
    df = spark.createDataFrame(rows, "w array<double>")
    assert [r[0] for r in df.select(dominant_index("w")).collect()] == [1, 0, 0, 0]


def test_counts_by_topic(spark):
    rows = [(0, "Positive"), (0, "Positive"), (1, "Neutral"), (None, "Neutral")]
    df = spark.createDataFrame(rows, "dominant_topic int, sentiment_label string")
    got = {tuple(r) for r in sentiment_by_topic(df).collect()}
    assert got == {(0, 0, 0, 2), (1, 0, 1, 0)}


TRAIN = [("a b b".split(), 1), ("a c".split(), 0), ("c c d".split(), 0), (None, 1), ("x".split(), None)]
SCORED = [(1, "a b".split()), (2, "c unseen".split()), (3, []), (4, None), (5, "a a a b c d".split())]


def brute(tokens, norm=False):
    train = [(t, y) for t, y in TRAIN if t is not None and y is not None]
    pos = [w for t, y in train if y for w in t]
    neg = [w for t, y in train if not y for w in t]
    v = len(set(pos + neg))
    ratio = sum(
        math.log((pos.count(w) + 1) / (len(pos) + v)) - math.log((neg.count(w) + 1) / (len(neg) + v)) for w in tokens
    )
    ratio = ratio / len(tokens) if norm and tokens else ratio
    return 1 / (1 + math.exp(-(ratio + math.log(1 / 2))))


@pytest.mark.parametrize("limit", [1000, 0])
@pytest.mark.parametrize("norm", [False, True])
def test_naive_bayes_matches_formula(spark, limit, norm):
    model = fit_sentiment(spark.createDataFrame(TRAIN, "tokens array<string>, label int"))
    df = spark.createDataFrame(SCORED, "doc_id int, tokens array<string>")
    got = {r[0]: r[1] for r in model.score(df, length_norm=norm, max_broadcast=limit).collect()}
    assert got[4] is None
    for i, tokens in SCORED:
        if tokens is not None:
            assert got[i] == pytest.approx(brute(tokens, norm))


def test_one_class_is_refused(spark):
    with pytest.raises(ValueError):
        fit_sentiment(spark.createDataFrame([(["a"], 1)], "tokens array<string>, label int"))


def scored(spark):
    rnd = random.Random(2)
    rows = [(i, rnd.choice([0, 0, 0, 1, 2]), rnd.choice([rnd.random(), 0.5, 5 * rnd.random()])) for i in range(2000)]
    rows += [(9001, 3, 0.25), (9002, 4, None), (9003, None, 0.3)]
    return spark.createDataFrame(rows, "id int, dominant_topic int, sentiment_score double"), rows


def test_box_and_outliers_against_numpy(spark):
    df, rows = scored(spark)
    got = {r["dominant_topic"]: r for r in sentiment_box(df).collect()}
    out = {r["id"] for r in sentiment_outliers(df).collect()}
    expect_out = set()
    assert set(got) == {0, 1, 2, 3}
    for topic, r in got.items():
        v = np.array([s for _, t, s in rows if t == topic and s is not None])
        q1, q2, q3 = np.percentile(v, [25, 50, 75])
        lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        kept = v[(v >= lo) & (v <= hi)]
        assert (r["q1"], r["median"], r["q3"]) == pytest.approx((q1, q2, q3))
        assert (r["whisker_low"], r["whisker_high"], r["n_outliers"]) == (kept.min(), kept.max(), len(v) - len(kept))
        expect_out |= {i for i, t, s in rows if t == topic and s is not None and not lo <= s <= hi}
    assert out == expect_out


def test_approximate_box_is_close(spark):
    df, _ = scored(spark)
    exact = sentiment_box(df).agg(F.sum("median")).first()[0]
    assert sentiment_box(df, exact=False).agg(F.sum("median")).first()[0] == pytest.approx(exact, abs=0.02)


def test_numbered_rows_are_not_written_again(spark, monkeypatch):
    """Repeated and null ids, null and empty tokens; both ways of joining the weights."""
    train = spark.createDataFrame([(["a", "b"], 1), (["b", "c"], 0)], "tokens array<string>, label int")
    model = sentiment.fit_sentiment(train)
    rows = [(1, ["a", "a", "x"]), (1, ["c"]), (None, ["b"]), (2, None), (3, [])]
    df = spark.createDataFrame(rows, "doc_id int, tokens array<string>")
    wanted = sorted(map(str, model.score(df).collect()))
    numbered, copies = scaling.with_row(df), []
    monkeypatch.setattr(sentiment, "with_row", lambda given: copies.append(given) or scaling.with_row(given))
    for limit in (1_000_000, 0):
        assert sorted(map(str, model.score(numbered, max_broadcast=limit).collect())) == wanted
    assert not copies
