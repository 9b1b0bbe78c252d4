"""The Kneser-Ney model against a plain Python version."""

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from opinionlens.llm.kneser_ney import discounts, fit_kneser_ney, score_texts


def tokens_of(text):
    return ["".join(c.lower() if c.isascii() else c for c in w) for w in (text or "").split()] + [None]


class Plain:
    def __init__(self, texts):
        self.pairs, self.words, contexts = Counter(), Counter(), defaultdict(set)
        for text in texts:
            before = "<s>"
            for t in tokens_of(text):
                self.pairs[before, t] += 1
                self.words[t] += 1
                contexts[t].add(before)
                before = t
        self.before = Counter({t: len(c) for t, c in contexts.items()})
        sizes = lambda counts: [sum(c == k for c in counts.values()) for k in (1, 2, 3, 4)]
        self.pair_d, self.word_d = discounts(sizes(self.pairs)), discounts(sizes(self.before))
        self.after = defaultdict(list)
        for (a, _), c in self.pairs.items():
            self.after[a].append(c)

    def word(self, t):
        if not self.pairs:
            return 1.0
        cut = lambda c: self.word_d[min(c, 3) - 1] if c else 0
        spare = sum(cut(c) for c in self.before.values()) / len(self.pairs)
        return (self.before[t] - cut(self.before[t])) / len(self.pairs) + spare / (len(self.words) + 1)

    def pair(self, a, t):
        if not self.after[a]:
            return self.word(t)
        cut = lambda c: self.pair_d[min(c, 3) - 1] if c else 0
        total = sum(self.after[a])
        spare = sum(cut(c) for c in self.after[a]) / total
        c = self.pairs[a, t]
        return (c - cut(c)) / total + spare * self.word(t)

    def score(self, text):
        found, before = 0.0, "<s>"
        for t in tokens_of(text):
            found += math.log10(self.pair(before, t))
            before = t
        return found


def random_texts(seed, n=200):
    """Each word is one of three that may follow the one before."""
    r = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["The", "the", "Été"]
    texts = []
    for _ in range(n):
        at, own = 0, []
        for _ in range(r.randrange(0, 30)):
            at = (7 * at + r.choice([1, 1, 1, 5, 11])) % len(words)
            own.append(words[at])
        texts.append(" ".join(own))
    return texts


@pytest.mark.parametrize("parts", [1, 7])
def test_matches_plain_version(spark, parts):
    texts = [*random_texts(1), None, "", "new words here the w1"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    model = fit_kneser_ney(df, F.col("doc_id") % 3 != 0, parts=parts)
    train = [t for i, t in enumerate(texts) if i % 3]
    plain = Plain(train)
    assert (model.tokens, model.vocabulary, model.pairs) == (sum(plain.words.values()), len(plain.words), len(plain.pairs))
    for row in score_texts(df, model).collect():
        own = tokens_of(texts[row.doc_id])
        assert row.n_tokens == len(own)
        assert row.n_known == sum(plain.words[t] > 0 for t in own)
        base = sum(math.log10((plain.words[t] + 1) / (model.tokens + model.vocabulary + 1)) for t in own)
        assert row.base_score == pytest.approx(base, rel=1e-9)
        assert row.score == pytest.approx(plain.score(texts[row.doc_id]), rel=1e-9)
    held = [r for r in score_texts(df, model).collect() if r.doc_id % 3 == 0]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_probabilities_sum_to_one():
    plain = Plain(random_texts(2))
    for a in ("<s>", "w1", "w7", "never seen"):
        assert sum(plain.pair(a, t) for t in [*plain.words, "unknown"]) == pytest.approx(1)


def test_edge_cases(spark):
    df = spark.createDataFrame([(1, "a b", 5), (1, "a b", 5), (None, None, 6)], "doc_id bigint, text string, score int")
    nothing = fit_kneser_ney(df.limit(0))
    assert {(r.n_tokens, r.n_known, r.score, r.base_score) for r in score_texts(df, nothing).collect()} == {(3, 0, 0.0, 0.0), (1, 0, 0.0, 0.0)}
    model = fit_kneser_ney(df)
    assert model.tokens == 7 and score_texts(df.limit(0), model).collect() == []
