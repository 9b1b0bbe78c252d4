import numpy as np
import pytest
from pyspark.sql.classic.dataframe import DataFrame

from opinionlens.functions.ranking import cosine
from opinionlens.operators import keywords
from opinionlens.operators.keywords import (
    cosine_topk,
    encode_texts,
    encode_words,
    fit_word2vec,
    frequency_keywords,
    keyword_columns,
    keyword_triples,
    ranked_keywords,
)
from opinionlens.operators.scaling import with_row


def vectors(n, seed, dup=False):
    out = np.random.default_rng(seed).normal(size=(n, 6))
    if dup:
        out[1::2] = out[::2]
    out[-1] = 0
    return out.tolist()


def brute(texts, words, k):
    def unit(m):
        m = np.array(m)
        n = np.linalg.norm(m, axis=1, keepdims=True)
        return m / np.where(n == 0, 1, n)

    names = [w for w, _ in words]
    sims = np.round(unit([v for _, v in texts]) @ unit([v for _, v in words]).T, 6)
    keep = [any(v) for _, v in words]
    return {
        i: sorted((p for p, fine in zip(zip(names, row.tolist()), keep) if fine), key=lambda p: (-p[1], p[0]))[:k] if any(v) else []
        for (i, v), row in zip(texts, sims)
    }


@pytest.mark.parametrize("limit", [1 << 20, 6 * 8 * 7])
def test_topk_matches_brute_force(spark, limit):
    texts = list(enumerate(vectors(37, 1)))
    words = [(f"w{i:02d}", v) for i, v in enumerate(vectors(30, 2, dup=True))]
    t = spark.createDataFrame(texts, "doc_id long, embedding array<float>").repartition(3)
    w = spark.createDataFrame(words, "word string, embedding array<float>")
    texts = [(r[0], r[1]) for r in t.collect()]
    words = [(r[0], r[1]) for r in w.collect()]
    got = {r["doc_id"]: [tuple(x) for x in r["keywords"]] for r in cosine_topk(t, w, 5, max_matrix_bytes=limit).collect()}
    assert got == brute(texts, words, 5)


def test_missing_vectors_and_few_words(spark):
    t = spark.createDataFrame([(1, [1.0, 0.0]), (2, None)], "doc_id int, embedding array<double>")
    w = spark.createDataFrame([("b", [1.0, 1.0]), ("a", [1.0, 1.0])], "word string, embedding array<double>")
    top = cosine_topk(t, w, 10)
    rows = {r["doc_id"]: r for r in keyword_triples(top).collect()}
    assert rows[1][1:4] == ("a", "b", None) and rows[1]["similarity_score"] == pytest.approx(0.707107)
    assert rows[2][1:] == (None, None, None, None)
    assert [tuple(r)[:3] for r in ranked_keywords(top).orderBy("rank").collect()] == [(1, 1, "a"), (1, 2, "b")]
    assert cosine_topk(t, w.limit(0), 3).count() == 2


def test_cosine_column(spark):
    df = spark.createDataFrame([([3.0, 4.0], [3.0, 4.0]), ([1.0, 0.0], [0.0, 0.0])], "a array<double>, b array<double>")
    assert [r[0] for r in df.select(cosine("a", "b")).collect()] == pytest.approx([1.0, 0.0])


def test_frequency_triples(spark):
    df = spark.createDataFrame([(1, "b a b".split()), (2, [])], "doc_id int, tokens array<string>")
    rows = keyword_columns(frequency_keywords(df)).orderBy("doc_id").collect()
    assert [(r["keyword1"], r["keyword2"], r["keyword3"]) for r in rows] == [("b", "a", None), (None, None, None)]


def test_word2vec_encoder(spark):
    df = spark.createDataFrame([(i, "a b c a".split()) for i in range(20)], "doc_id int, tokens array<string>")
    model = fit_word2vec(df, size=8, partitions=1)
    words = encode_words(model)
    assert {r["word"] for r in words.collect()} == {"a", "b", "c"}
    top = cosine_topk(encode_texts(model, df), words, 10).collect()
    for r in top:
        sims = [k["similarity"] for k in r["keywords"]]
        assert len(sims) == 3 and sims == sorted(sims, reverse=True)


@pytest.mark.parametrize("groups", [1, 3])
def test_topk_reads_all_blocks_in_one_pass(spark, groups, monkeypatch):
    """A block of words more used to be a job more, and every word passed through the driver."""
    monkeypatch.setattr(keywords, "GROUP_BYTES", 2100 // groups)
    monkeypatch.setattr(keywords, "SLICE_ROWS", 10)
    monkeypatch.setattr(DataFrame, "toArrow", None)
    written = []
    monkeypatch.setattr(keywords, "with_row", lambda df: written.append(df) or with_row(df))
    texts, words = list(enumerate(vectors(37, 3))), [(f"w{i % 9:02d}", v) for i, v in enumerate(vectors(18, 4, dup=True))]
    t = spark.createDataFrame(texts, "doc_id long, embedding array<double>")
    w = spark.createDataFrame(words, "word string, embedding array<double>")
    got = {r["doc_id"]: [tuple(x) for x in r["keywords"]] for r in cosine_topk(t, w, 5, max_matrix_bytes=1).collect()}
    assert got == brute(texts, words, 5) and len(written) == 2
