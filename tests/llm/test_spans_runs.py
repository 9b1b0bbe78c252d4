"""Sentence spans against all runs of several sentences."""

import random

import pytest
from test_spans import sentences

from opinionlens.llm.spans import dedup_spans


def all_runs(docs, min_sentences=2, min_words=20):
    spans = {}
    for doc_id, text in sorted(docs):
        own = sentences(text)
        for i in range(len(own)):
            for j in range(i + min_sentences, len(own) + 1):
                words = tuple(w for s in own[i:j] for w in s[0])
                if len(words) >= min_words:
                    spans.setdefault(words, []).append((doc_id, i, j))
    gone = {}
    for places in spans.values():
        for doc_id, i, j in places[1:]:
            gone.setdefault(doc_id, set()).update(range(i, j))
    out = []
    for doc_id, text in docs:
        own, cut = sentences(text), gone.get(doc_id, set())
        out.append((doc_id, "".join(r for k, (_, r) in enumerate(own) if k not in cut), len(own), len(cut)))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_matches_all_runs(spark, seed):
    r = random.Random(seed)
    sentence = lambda: " ".join(r.choices(["alpha", "été", "of", "the", "größe", "x", "end"], k=r.randrange(1, 15))) + r.choice(".!?")
    shared = [" ".join(sentence() for _ in range(r.randrange(2, 8))) for _ in range(8)]
    docs = [(i, " ".join(r.choice(shared) if r.random() < 0.4 else sentence() for _ in range(r.randrange(1, 8)))) for i in range(150)]
    got = dedup_spans(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5))
    assert sorted(map(tuple, got.collect())) == sorted(all_runs(docs))


def test_tail_of_a_passage(spark):
    words = [" ".join(f"{c}{i}" for i in range(n)) + "." for c, n in zip("abc", (12, 10, 9), strict=True)]
    docs = [(1, " ".join(words)), (2, "Begin. " + " ".join(words) + " Another end."), (3, " ".join(words) + "\n")]
    got = {r.doc_id: r.text for r in dedup_spans(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    assert got == {1: docs[0][1], 2: "Begin. Another end.", 3: ""}
