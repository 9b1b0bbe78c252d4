"""Nearest neighbours against brute force."""

import numpy as np

from opinionlens.llm.neighbours import nearest_neighbours


def brute(rows, k, is_query):
    rows = sorted(rows)
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], float)
    found = {}
    for i in np.flatnonzero([is_query(j) for j in ids]):
        cosine = (x @ x[i]) / np.linalg.norm(x, axis=1) / np.linalg.norm(x[i])
        order = sorted((-round(c, 12), j) for c, j in zip(cosine, ids) if j != ids[i])
        found[int(ids[i])] = [(int(j), -c) for c, j in order[:k]]
    return found


def answers(df, k=5, every=10):
    got = {}
    for r in nearest_neighbours(df, lambda i: i % every == 0, k=k).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(got[r.query_id])
    return got


def test_recall(spark):
    r = np.random.default_rng(3)
    centres = r.normal(size=(6, 24))
    rows = [(i, [float(x) for x in centres[i % 6] + r.normal(size=24)]) for i in range(1500)]
    got = answers(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(5))
    expect = brute([(i, np.float32(v)) for i, v in rows], 5, lambda i: i % 10 == 0)
    assert got.keys() == expect.keys()
    hits = sum(len({v for v, _ in got[q]} & {v for v, _ in expect[q]}) for q in expect)
    assert hits >= 0.95 * 5 * len(expect)
    for q, found in got.items():
        exact = dict(expect[q])
        assert all(abs(exact[v] - s) < 1e-9 for v, s in found if v in exact)


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (10, [1.0, 0.0]), (3, [2.0, 0.0]), (4, [1.0, 0.0]), (5, [0.0, 1.0]), (20, [0.0, 0.0]), (30, None), (40, [])]
    rows += [(50, [nan, 1.0]), (60, [None, 1.0]), (70, [inf, 1.0]), (80, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (5, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = answers(df)
    assert got == {0: [(3, 1.0), (4, 1.0), (10, 1.0), (5, 0.0)], 10: [(0, 1.0), (3, 1.0), (4, 1.0), (5, 0.0)]}
    assert answers(df.limit(0)) == {}
    assert answers(df.filter("vec_id = 0")) == {}
    assert answers(df.filter("vec_id in (0, 4)"), k=1) == {0: [(4, 1.0)]}


def test_many_equal_vectors(spark):
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(300)] + [(i, [float(i), 1.0, 0.0]) for i in range(300, 330)]
    got = answers(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), every=100)
    assert [v for v, _ in got[100]] == [0, 1, 2, 3, 4] and [v for v, _ in got[0]] == [1, 2, 3, 4, 5]
