"""Ranked search against a plain version that scores every document."""

import math
import random
import re
from collections import Counter

import numpy as np

from opinionlens.llm import lexical
from opinionlens.llm.lexical import Queries, Shard, search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(docs, items, k=10):
    terms = [(d, TERM.findall((t or "").translate(LOWER))) for d, t in docs]
    n_docs, n_terms = sum(1 for _, w in terms if w), sum(len(w) for _, w in terms)
    df = Counter(t for _, w in terms for t in set(w))
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df.items()}
    out = []
    for item, text in items:
        scores = []
        for d, w in terms:
            tf, m = Counter(w), 25 + (75 * len(w) * n_docs) // max(n_terms, 1)
            own = [t for t in TERM.findall((text or "").translate(LOWER)) if tf[t]]
            score = sum(weight[t] * (1_000_000_000 * tf[t] // (1000 * tf[t] + 8 * m)) for t in own)
            if score > 0:
                scores.append((-score, d is None, d or 0, d))
        out += [(item, i, x[3], -x[0]) for i, x in enumerate(sorted(scores, key=lambda x: x[:3])[:k], 1)]
    return out


def random_tables(seed, n=400):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(300)] + ["été", "Größe", "日本", "İ", "a1", "The", "of"]
    weights = [1 / (i + 1) for i in range(len(words))]
    text = lambda m: "".join(x + r.choice([" ", "-", ", ", "\n", "_"]) for x in r.choices(words, weights, k=m))
    docs = [(i, text(r.randrange(0, 80))) for i in range(n)]
    docs += [(i + n, docs[i][1]) for i in range(60)]  # copies: equal scores
    docs += [(5000, None), (5001, ""), (5002, " .,! "), (None, docs[3][1]), (7, docs[7][1])]
    items = [(i, text(r.randrange(1, 40))) for i in range(30)] + [(90, None), (91, ""), (92, "unknownterm"), (93, "w1 w1 w1 w2"), (93, "w1 w1 w1 w2")]
    return docs, items


def test_matches_plain_version(spark):
    for seed, block in ((1, 500), (2, 7)):
        docs, items = random_tables(seed)
        d = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
        q = spark.createDataFrame(items, "item_id bigint, text string")
        got = search(d, q, query_block=block)
        assert got.columns == ["item_id", "rank", "doc_id", "score"]
        assert sorted(map(tuple, got.collect()), key=str) == sorted(plain(docs, items), key=str)


def test_small_shards_and_blocks_skip_exactly():
    """Blocks of four documents in shards: the best are whole, and blocks were skipped."""
    r = np.random.default_rng(4)
    counts = [{int(t): int(r.integers(1, 3)) for t in r.choice(40, 6, replace=False)} for _ in range(20)]
    queries = Queries(list(range(20)), counts)
    topic = r.integers(0, 8, 600)
    values = np.where(r.random((600, 40)) < np.where((np.arange(40) % 8)[None, :] == topic[:, None], 0.8, 0.05), r.integers(1, 1 << 34, (600, 40)), 0)
    own = Shard(queries, values[:, sorted(queries.place)] if len(queries.place) < 40 else values)
    opened = 0
    for q in range(20):
        full = own.values[:, queries.terms[q]] @ queries.times[q]
        docs, scores = own.open(queries, q, 1, 10)
        assert (scores == full[docs]).all()
        expect = sorted(zip(-full, range(600)))[:10]
        assert sorted(zip(-scores, docs))[:10] == expect
        opened += len(docs)
    blocks = [b for b in own.lists if len(b[1]) > 1]
    assert blocks and all((b[2] >= 0).all() for b in blocks)
    for docs, begins, summary in own.lists:
        assert len(summary) == len(begins) and len(np.unique(docs)) == len(docs)


def test_very_long_texts_ties_and_edge_cases(spark, monkeypatch):
    docs = [(i, "alpha beta gamma") for i in range(40)] + [(100, "alpha " * 300_000 + "delta"), (101, "x" * 500_000)]
    items = [(1, "ALPHA alpha delta"), (2, "beta")]
    d = spark.createDataFrame([(*r, "s", 1) for r in docs], "doc_id bigint, text string, score string, rank int").repartition(3)
    q = spark.createDataFrame([(*r, "x") for r in items], "item_id bigint, text string, doc_id string")
    got = search(d, q)
    assert sorted(map(tuple, got.collect())) == sorted(plain(docs, items))
    assert [x.doc_id for x in got.filter("item_id = 2").orderBy("rank").collect()] == list(range(10))
    assert search(d.limit(0), q).collect() == [] and search(d, q.limit(0)).collect() == []
    monkeypatch.setattr(lexical, "CELLS", 12)
    assert sorted(map(tuple, search(d, q).collect())) == sorted(plain(docs, items))
