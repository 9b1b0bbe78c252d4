"""Passages that stand at unequal places of their texts."""

import random

import pyarrow as pa
import pytest

from opinionlens.llm.spans import MAX_SENTENCE, QUIET, WINDOW, Sentences, dedup_spans

EDGE = QUIET + WINDOW  # words that may stay at either end of a passage inside a sentence


def new_words(tag, n):
    return [f"{tag}{i}" for i in range(n)]


def runs_left(text, passage):
    """Numbers of the passage's words that are left in the text."""
    left = set(text.split())
    return [i for i, w in enumerate(passage) if w in left]


@pytest.mark.parametrize("length", [50, 60, 200])
@pytest.mark.parametrize("mark", ["", "。"])
def test_unmarked_passages(spark, length, mark):
    docs, passages = [], []
    for k in range(40):
        passage = [w + mark * (i % 9 == 8) for i, w in enumerate(new_words(f"p{k}x{length}y", length))]
        passages.append(passage)
        for copy in range(2):
            before, behind = new_words(f"b{k}c{copy}n", (7 * k + 11 * copy) % 70), new_words(f"e{k}c{copy}n", (5 * k + 3 * copy) % 50)
            docs.append((2 * k + copy, " ".join(before + passage + behind)))
    got = {r.doc_id: r.text for r in dedup_spans(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    for k, passage in enumerate(passages):
        assert got[2 * k] == docs[2 * k][1]
        left = runs_left(got[2 * k + 1], passage)
        assert not [i for i in left if EDGE < i < length - 1 - EDGE], (k, left)
        others = [w for w in docs[2 * k + 1][1].split() if w not in passage]
        assert [w for w in got[2 * k + 1].split() if w not in passage] == others


def test_two_sentences_inside_a_hosts_sentence(spark):
    docs, passages = [], []
    for k in range(40):
        passage = new_words(f"s{k}x", 28) + new_words(f"t{k}x", 28)
        passage[27] += "."
        passages.append(passage)
        docs.append((2 * k, " ".join(passage) + ". Its own end here."))
        docs.append((2 * k + 1, " ".join(new_words(f"b{k}n", k % 13 + 1) + passage + new_words(f"e{k}n", k % 11)) + "."))
    got = {r.doc_id: r.text for r in dedup_spans(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    for k, passage in enumerate(passages):
        assert got[2 * k] == docs[2 * k][1]
        assert not [i for i in runs_left(got[2 * k + 1], passage) if EDGE < i < 55 - EDGE]


def test_length_of_sentences():
    r = random.Random(3)
    texts = [" ".join(r.choices(["a", "b", "c"], k=300)), "na " * 300, " ".join(new_words("w", 300)), " ".join(new_words("w", 16)) + ".", "one", ""]
    found = Sentences(pa.array(texts, pa.large_string()))
    sizes = found.first[1:] - found.first[:-1]
    assert sizes.max() <= MAX_SENTENCE and (sizes[found.rows == 3] == 16).all()
    assert [int(x) for x in found.of_row[1:] - found.of_row[:-1]][3:] == [1, 1, 0]
