"""Operators with a way for small and one for large inputs: equal rows from both, whatever the ids."""

import pytest
from pyspark.sql import functions as F

from opinionlens.operators.emotion import fit_emotion, predict_emotion
from opinionlens.operators.keywords import cosine_topk, keyword_triples
from opinionlens.operators.segment import segment
from opinionlens.operators.sentiment import fit_sentiment
from opinionlens.operators.stopwords import stopword_filter
from opinionlens.operators.store import append_rows
from opinionlens.operators.topics import fit_topics

TOKENS = [(1, ["a", "x", None, "x"]), (None, ["x", "a"]), (2, ["p", "a"]), (2, ["q"]), (None, None), (3, []), (4, ["a", " "])]


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def tokens(spark):
    return spark.createDataFrame(TOKENS, "doc_id long, tokens array<string>")


@pytest.mark.parametrize("drop_blank", [False, True])
def test_stopwords(spark, tokens, drop_blank):
    stop = spark.createDataFrame([("a",), (None,), ("a",)], "word string")
    literal = rows(stopword_filter(tokens, stop, drop_blank=drop_blank))
    assert literal == rows(stopword_filter(tokens, stop, drop_blank=drop_blank, max_literal=0))
    assert (1, TOKENS[0][1], ["x", "x"]) in literal and (None, ["x", "a"], ["x"]) in literal


def test_segments(spark):
    lexicon = spark.createDataFrame([("医生", 80.0), ("工资", 70.0), ("w" * 500, 1.0), ("[cry]", 3.0)], "word string, freq double")
    texts = [(None, "医生工资"), (None, "[cry] low"), (5, "[cry] low 医生"), (5, "x医生y z"), (6, None), (7, "")]
    df = spark.createDataFrame(texts, "doc_id long, cleaned_content string")
    shared = rows(segment(df, lexicon))
    assert shared == rows(segment(df, lexicon, max_shared=0))
    assert (5, "[cry] low 医生", ["[cry]", "low", "医生"]) in shared and (None, "[cry] low", ["[cry]", "low"]) in shared
    assert (None, "医生工资", ["医生", "工资"]) in shared and (5, "x医生y z", ["x", "医生", "y", "z"]) in shared


def test_cosine_lists(spark):
    texts = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (None, [1.0, 1.0]), (2, [0.0, 0.0]), (3, None)]
    words = [("a", [1.0, 0.0]), ("b", [0.0, 1.0]), ("c", [1.0, 1.0]), ("d", [0.0, 0.0]), ("e", None), (None, [1.0, 0.0]), ("f", [-1.0, 0.5])]
    df = spark.createDataFrame(texts, "doc_id long, embedding array<double>")
    names = spark.createDataFrame(words, "word string, embedding array<double>")
    one = rows(cosine_topk(df, names, 2))
    assert one == rows(cosine_topk(df, names, 2, max_matrix_bytes=100)) and len(one) == 5
    assert rows(keyword_triples(cosine_topk(df, names, 2)).filter("doc_id > 1")) == [(2, None, None, None, None), (3, None, None, None, None)]
    assert rows(keyword_triples(cosine_topk(df, names, 2)).filter("doc_id is null"))[0][1:3] == ("c", "a")


def test_naive_bayes_scores_every_row(spark, tokens):
    train = spark.createDataFrame([(["x", "p"], 1), (["a", "q"], 0)], "tokens array<string>, label int")
    model = fit_sentiment(train)
    scored = rows(model.score(tokens).select("doc_id", F.round("sentiment_score", 9)))
    assert scored == rows(model.score(tokens, max_broadcast=0).select("doc_id", F.round("sentiment_score", 9)))
    assert len(scored) == len(TOKENS) and len({s for d, s in scored if d == 2}) == 2


def test_store_takes_one_row_of_a_key_and_refuses_null(spark):
    none = spark.createDataFrame([], "id long, doc_id long")
    batch = spark.createDataFrame([(4, "x"), (2, "y"), (4, "z"), (2, "y")], "doc_id long, text string")
    stored = append_rows(none, batch)
    assert [(r[0], r[1]) for r in rows(stored)] == [(1, 2), (2, 4)]
    assert append_rows(stored, batch.repartition(3)).count() == 0
    with pytest.raises(ValueError):
        append_rows(none, spark.createDataFrame([(None, "x")], "doc_id long, text string"))


def test_topics_keep_every_word_in_a_fixed_order(spark):
    df = spark.createDataFrame([(["b", "a"],), (["b", "c"],), (None,)], "tokens array<string>")
    assert fit_topics(df, passes=1).words == ["b", "a", "c"]
    with pytest.raises(ValueError):
        fit_topics(df, passes=1, max_vocabulary=2)


def test_emotion_reads_the_whole_text(spark):
    fill = ["w"] * 200
    data = [(fill + ["good"], 6), (fill + ["bad"], 0)] * 4
    df = spark.createDataFrame(data, "tokens array<string>, label_id int")
    model = fit_emotion(df, features=1 << 10)
    assert {tuple(r) for r in predict_emotion(model, df).select("label_id", "prediction_id").collect()} == {(6, 6), (0, 0)}
