"""The set join against all pairs compared in plain Python."""

import random

import numpy as np
import pytest

from opinionlens.llm.jaccard import SetJoin, components, jaccard_components, levels, signatures, sketch


def brute(docs, n=4, percent=85):
    sets = []
    for _, text in docs:
        w = "".join(c.lower() if c.isascii() else c for c in text or "").split()
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, x in enumerate(sets):
        for j in range(i):
            if x and sets[j] and 100 * len(x & sets[j]) >= percent * len(x | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return [(d, len(s), least.get(find(i))) for i, ((d, _), s) in enumerate(zip(docs, sets))]


def random_docs(seed, families=12, members=14):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    passage = [r.choice(words) for _ in range(40)]
    docs = []
    for _ in range(families):
        base = [r.choice(words) for _ in range(r.choice([3, 5, 9, 14, 30, 60, 120, 300]))]
        if r.random() < 0.5:
            base = base[: len(base) // 2] + passage + base[len(base) // 2 :]
        for _ in range(members):
            own = list(base)
            for _ in range(r.randrange(0, 1 + len(own) // 25)):
                own[r.randrange(len(own))] = r.choice(words)
            if r.random() < 0.2:
                own = own[: -r.randrange(1, 4)]
            docs.append(" ".join(own))
    r.shuffle(docs)
    return list(enumerate(docs, 1))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_matches_all_pairs(spark, seed):
    docs = [*random_docs(seed), (900, None), (901, ""), (902, " \n"), (903, "A b"), (904, "a B")]
    got = jaccard_components(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5))
    assert sorted(map(tuple, got.collect())) == sorted(brute(docs))


def test_nulls_repeats_and_other_columns(spark):
    text = "one two three four five six seven"
    rows = [(None, text, 1), (7, text, 2), (7, text, 2), (None, "alone in the whole world", 3), (8, None, 4)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, cls int")
    got = sorted(map(tuple, jaccard_components(df).select("doc_id", "n_shingles", "component_id", "cls").collect()), key=str)
    assert got == sorted([(None, 4, 7, 1), (7, 4, 7, 2), (7, 4, 7, 2), (None, 2, None, 3), (8, 0, 8, 4)], key=str)
    assert jaccard_components(df.limit(0)).collect() == []


def test_linked_sets_share_a_list():
    join, r = SetJoin(), np.random.default_rng(5)
    for _ in range(3000):
        n = int(r.choice([1, 2, 6, 7, 8, 9, 12, 13, 20, 21, 34, 60, 200]))
        x = np.unique(r.integers(0, 2**64, n, dtype=np.uint64))
        gone = r.integers(0, join.max_difference(2 * n) + 1)
        cut = r.integers(0, gone + 1)
        y = np.unique(np.concatenate([r.permutation(x)[cut:], r.integers(0, 2**64, gone - cut, dtype=np.uint64)]))
        same = len(np.intersect1d(x, y))
        if same and 100 * same >= 85 * (len(x) + len(y) - same):
            assert np.intersect1d(signatures(x, join), signatures(y, join)).size
            bits = [int.from_bytes(sketch(s)[:32], "little") for s in (x, y)]
            assert (bits[0] ^ bits[1]).bit_count() <= len(x) + len(y) - 2 * same
    assert [levels(8, join), levels(6, join), levels(9, join)] == [[(0, 8), (1, 13)], [(0, 8)], [(1, 13)]]


def test_components_of_chains(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (205, 203), (203, 204), (5, 5)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()))
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 203: 203, 204: 203, 205: 203}


def test_only_sets_that_may_link_travel(spark, monkeypatch):
    """Texts that share a passage and no more are told apart by their sketches; their sets are not made."""
    from opinionlens.llm import jaccard

    r = random.Random(31)
    passage = " ".join(f"p{i}" for i in range(60))
    docs = [(i, passage + " " + " ".join(f"x{r.randrange(10**6)}" for _ in range(150))) for i in range(40)]
    docs += [(100 + i, text + " more") for i, text in docs[:5]]
    asked, items = [], jaccard.class_items
    monkeypatch.setattr(jaccard, "class_items", lambda docs, wanted, *rest: asked.append(wanted.count()) or items(docs, wanted, *rest))
    got = jaccard_components(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3))
    assert sorted(map(tuple, got.collect())) == sorted(brute(docs))
    assert asked and max(asked) <= 10
