import random
import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from opinionlens.functions.text import (
    clean_text,
    drop_words,
    explode_counts,
    frequent_words,
    join_tokens,
    tokenize,
    truncate_tokens,
    word_counts,
)
from opinionlens.operators.features import bag_of_words, tfidf_top, tokens_of, vocabulary, word_index
from opinionlens.operators.stopwords import stopword_filter

CLEAN = [
    ("Hello,[笑哭R] 世界!", "hello[笑哭] 世界"),
    ("工资　低 啊\tX", "工资 低 啊 x"),
    ("[R]", "[]"),
    ("[[abR]]", "[[ab]]"),
    ("é", "e"),
    ("²½①", "²½①"),
    ("a\u001cb", "a b"),
    (None, ""),
    ("!!!", ""),
    ("a_b 9", "a_b 9"),
]


def column(spark, values, expr, ddl="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, x {ddl}")
    return [r[0] for r in df.select("i", expr.alias("y")).orderBy("i").select("y").collect()]


def twin(text):
    text = re.sub(r"\[([^\]]*)R\]", r"[\1]", text)
    text = re.sub(r"[^\w\s\[\]]", "", text)
    return " ".join(text.lower().split())


def test_clean_rows(spark):
    assert column(spark, [a for a, _ in CLEAN], clean_text("x")) == [b for _, b in CLEAN]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="[]R aZé中文笑_1²\t\n　 \u001c!?,.'́ßÑ", max_size=30), min_size=20, max_size=60))
def test_clean_matches_twin(spark, texts):
    assert column(spark, texts, clean_text("x")) == [twin(t) for t in texts]


def test_tokenize(spark):
    assert column(spark, ["a b", "", None, "  x "], tokenize("x")) == [["a", "b"], [], [], ["x"]]


def test_drop_words(spark):
    rows = [["我", "的", "工资", "的", "工资"], ["The", "the"], [], None]
    got = column(spark, rows, drop_words("x", ["的", "the"]), "array<string>")
    assert got == [["我", "工资", "工资"], ["The"], [], []]
    assert column(spark, [["a", " "]], drop_words("x", [], drop_blank=True), "array<string>") == [["a"]]
    assert column(spark, rows[:1], join_tokens(drop_words("x", ["的"])), "array<string>") == ["我工资工资"]
    assert column(spark, [list("abc")], truncate_tokens("x", 2), "array<string>") == [["a", "b"]]


def random_docs(n=40, seed=1):
    rnd = random.Random(seed)
    return [rnd.choices(["the", "a", "b", "c", "中", "é"], [8, 1, 1, 1, 1, 1], k=rnd.randint(0, 30)) for _ in range(n)]


def test_word_counts(spark):
    docs = random_docs()
    got = column(spark, docs, word_counts("x"), "array<string>")
    for doc, bag in zip(docs, got):
        assert [(r["word"], r["cnt"]) for r in bag] == sorted(Counter(doc).items())
    top = column(spark, docs, frequent_words(word_counts("x"), 2), "array<string>")
    for doc, words in zip(docs, top):
        assert words == [w for w, _ in sorted(Counter(doc).items(), key=lambda p: (-p[1], p[0]))][:2]


def test_counting_stays_single_when_filtered(spark):
    df = spark.createDataFrame([(1, ["a", "b", "a"])], "doc_id int, tokens array<string>")
    plan = explode_counts(df, "doc_id").filter("word = 'a'")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("sort_array") == 1


def test_vocabulary_and_ids(spark):
    docs = random_docs()
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id int, tokens array<string>")
    got = {r["word"]: (r["df"], r["cnt"]) for r in vocabulary(df).collect()}
    words = {w for d in docs for w in d}
    assert got == {w: (sum(w in d for d in docs), sum(d.count(w) for d in docs)) for w in words}
    ids = {r["word"]: r["word_id"] for r in word_index(vocabulary(df)).collect()}
    assert ids == {w: i for i, w in enumerate(sorted(words))}
    assert bag_of_words(df).count() == sum(len(set(d)) for d in docs)
    assert [r["keyword"] for r in tfidf_top(df, n=1).collect()] == ["the"]


@pytest.mark.parametrize("limit", [20_000, 0])
def test_stopword_paths_agree(spark, limit):
    docs = random_docs()
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id int, tokens array<string>")
    stop = spark.createDataFrame([("the",), ("b",), ("b",), ("zz",)], "w string")
    got = stopword_filter(df, stop, max_literal=limit).orderBy("doc_id").collect()
    assert [r["filtered"] for r in got] == [[w for w in d if w not in {"the", "b"}] for d in docs]


def test_tokens_of(spark):
    df = spark.createDataFrame([("A b!",)], "text string")
    assert tokens_of(df).first()["tokens"] == ["a", "b"]
    assert F.col is not None
