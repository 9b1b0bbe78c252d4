"""Periodic runs against a plain search."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from opinionlens.llm.periodic import Grammar, find_runs, periodic_runs
from opinionlens.llm.q_periodic import op12_periodic_runs


def plain_runs(words, least=12):
    """(start, length, smallest period) of every maximal run, period by period."""
    n, found = len(words), {}
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            if words[i] != words[i + p]:
                i += 1
                continue
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            length = j + p - i
            if length >= max(least, 2 * p):
                found.setdefault((i, length), p)  # the smallest period comes first
            i = j + 1
    return sorted((s, n_, p) for (s, n_), p in found.items())


def plain_query(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    gone = {i for s, n_, p in runs for i in range(s + p, s + n_)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    last = (digest("".join(f"{s},{n_},{p}\n" for s, n_, p in sorted(runs, key=lambda r: (r[0], r[2])))),)
    last += (digest(" ".join(w for i, w in enumerate(words) if i not in gone)),)
    return (doc_id, len(runs), *((best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4), *last)


def sequence(r, kind, n):
    if kind == "same":
        return [0] * n
    if kind == "fibonacci":
        a, b = [0], [0, 1]
        while len(b) < n:
            a, b = b, b + a
        return b[:n]
    if kind == "periodic":
        own = [r.randrange(3) for _ in range(r.randrange(1, 9))] * n
        out = own[:n]
        for _ in range(n // 25):
            out[r.randrange(n)] = r.randrange(3)
        return out
    return [r.randrange(int(kind)) for _ in range(n)]


@pytest.mark.parametrize("kind", ["same", "fibonacci", "periodic", "2", "3", "30"])
def test_runs_match_plain_search(kind):
    r = random.Random(kind)
    for n in (0, 1, 11, 12, 13, 40, 150, 400):
        texts = [sequence(r, kind, n), sequence(r, kind, max(0, n - 7))]
        flat, firsts = [1000], []
        for k, t in enumerate(texts):
            firsts.append(len(flat))
            flat += [*t, 1001 + k]
        got = periodic_runs(np.array(flat), n)
        for first, t in zip(firsts, texts, strict=True):
            mine = [(int(s - first), int(e - s), int(p)) for s, e, p in got if first <= s < first + len(t)]
            assert sorted(mine) == plain_runs(t), (kind, n)


def test_extensions_match_plain_comparison():
    r = random.Random(3)
    for kind in ("same", "fibonacci", "periodic", "2", "40"):
        own = [7000, *sequence(r, kind, 300), 7001]
        grammar = Grammar.of(np.array(own))
        pairs = np.array([(i, j) for i in range(1, 300, 3) for j in range(i + 1, 301, 2)])
        plain = lambda i, j: next(k for k in range(len(own)) if own[i + k] != own[j + k])
        assert grammar.extend(pairs[:, 0], pairs[:, 1]).tolist() == [plain(i, j) for i, j in pairs]
        turned = own[::-1]
        plain_back = lambda i, j: next(k for k in range(len(own)) if turned[i + k] != turned[j + k])
        assert grammar.mirror().extend(pairs[:, 1], pairs[:, 0]).tolist() == [plain_back(j, i) for i, j in pairs]


def test_query_matches_plain_version(spark, tmp_path):
    r = random.Random(9)
    words = ["the", "été", "of", "x y", "größe", "日本", "a.", "b"]
    rows = [(i, "".join(r.choice(words) + r.choice([" ", "  ", "\n", "\t\x0b", "\r\f"]) for _ in range(r.randrange(0, 200)))) for i in range(300)]
    rows += [(7, "again " * 40), (7, "again " * 40), (900, None), (901, ""), (902, " \n"), (None, "one two " * 12), (903, " lead " + "p q r " * 9)]
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5).write.parquet(str(tmp_path / "documents.parquet"))
    got = op12_periodic_runs(spark, str(tmp_path))
    assert got.columns[:2] == ["doc_id", "n_runs"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted((plain_query(*row) for row in rows), key=str)


def test_very_long_texts_and_edge_cases(spark):
    r = random.Random(1)
    # One word 400,000 times; a period of 70,000 words repeated twice and a half.
    piece = [f"w{r.randrange(500)}" for _ in range(70_000)]
    rows = [(1, "x " * 400_000, "kept"), (2, " ".join(["first", *piece, *piece, *piece[:35_000]]), "kept")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, runs string").withColumnRenamed("runs", "other")
    got = {x.doc_id: x for x in find_runs(df).collect()}
    assert [tuple(x) for x in got[1].runs] == [(0, 400_000, 1)] and got[1].collapsed == "x"
    assert (1, 175_000, 70_000) in [tuple(x) for x in got[2].runs] and got[2].other == "kept"
    clash = df.withColumn("n_words", df.other).withColumn("collapsed", df.other)
    assert {x.n_words for x in find_runs(clash).collect()} == {400_000, 175_001}
    assert find_runs(df.limit(0)).collect() == []
