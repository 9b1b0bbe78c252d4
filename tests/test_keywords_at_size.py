import numpy as np
import pyarrow as pa
import pytest

from opinionlens.operators import keywords, word_vectors
from opinionlens.operators.keywords import _Best, _dealt, _unit, cosine_topk, encode_words, fit_word2vec
from opinionlens.operators.scaling import with_row
from opinionlens.operators.word_blocks import Exchange


def plain(texts, names, words, k):
    sims = np.round(texts @ words.T, 6)
    return [sorted(zip(-s, names))[:k] for s in sims]


def best(texts, names, words, k, batch):
    kept = _Best(texts, k)
    for a in range(0, len(words), batch):
        kept.add(pa.array(names[a : a + batch]), words[a : a + batch])
    return [[(-x["similarity"], x["keyword"]) for x in row] for row in kept.lists().to_pylist()]


@pytest.mark.parametrize("kind", ["alike", "spread", "equal"])
def test_words_left_out_by_angle_are_not_among_the_best(kind, monkeypatch):
    monkeypatch.setattr(keywords, "FIRST_WORDS", 40)
    monkeypatch.setattr(keywords, "ALIKE", 16)
    monkeypatch.setattr(keywords, "CELLS", 900)
    rng = np.random.default_rng(8)
    middles, words = rng.normal(size=(4, 8)), _unit(rng.normal(size=(900, 8)))
    texts = {"alike": middles[rng.integers(0, 4, 300)] + 0.1 * rng.normal(size=(300, 8)), "spread": rng.normal(size=(300, 8)), "equal": np.repeat(middles, 75, axis=0)}[kind]
    texts[::50] = rng.normal(size=(6, 8))  # far from the others
    texts = _unit(texts)
    if kind == "equal":
        words[100:700] = words[100]
    names = [f"w{i:03d}" for i in rng.permutation(900)]
    assert best(texts, names, words, 7, 130) == plain(texts, names, words, 7)
    assert best(texts[:3], names[:4], words[:4], 7, 2) == plain(texts[:3], names[:4], words[:4], 7)


def test_few_words_are_compared_where_texts_are_alike(monkeypatch):
    """Every word used to be compared with every text."""
    rng, seen = np.random.default_rng(9), []
    words = _unit(rng.normal(size=(20_000, 32)))
    texts = _unit(words[:3].repeat(200, axis=0) + 0.01 * rng.normal(size=(600, 32)))
    words[3:43] = _unit(words[:1] + 0.1 * rng.normal(size=(40, 32)))
    nonzero = np.nonzero
    monkeypatch.setattr(np, "nonzero", lambda x: seen.append(x.size) or nonzero(x))
    kept = _Best(texts, 10)
    for a in range(0, 20_000, 5000):
        kept.add(pa.array([f"w{i}" for i in range(a, a + 5000)]), words[a : a + 5000])
    assert len(kept.lists()) == 600 and sum(seen) < 600 * 20_000 / 5


def test_cells_copy_few_bytes():
    """Words, ten times as many bytes as the texts, went to one slice of texts for each core."""
    assert _dealt(51_282, 718_553, 32, 10, 1, 6) == (1, 6)
    assert _dealt(1_000_000, 300, 32, 10, 1, 6) == (8, 1)
    assert _dealt(3, 3, 32, 10, 1, 6) == (1, 1)
    slices, groups = _dealt(512_820, 3_000_000, 32, 10, 4, 6)
    assert groups >= 4 and slices == 4


def test_single_precision_words(spark):
    rng = np.random.default_rng(10)
    texts, words = rng.normal(size=(30, 4)), rng.normal(size=(50, 4)).astype(np.float32)
    t = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(texts)], "doc_id long, embedding array<double>")
    rows = [(f"w{i:02d}", v.tolist()) for i, v in enumerate(words)]
    single = spark.createDataFrame(rows, "word string, embedding array<float>")
    double = spark.createDataFrame(rows, "word string, embedding array<double>")
    one, two = ({r["doc_id"]: r["keywords"] for r in cosine_topk(t, w, 5).collect()} for w in (single, double))
    assert one == two and len(one) == 30


def test_first_vectors_do_not_move(spark, monkeypatch):
    """Blocks pulled all vectors at the start of the first iteration, though these come from the words themselves."""
    pulled, pull = [], Exchange.pull
    monkeypatch.setattr(Exchange, "pull", lambda self, counted, width=None: pulled.append(width) or pull(self, counted, width))
    docs = [(i, [f"w{j}" for j in range(i % 5)] + ["rare" if i == 3 else "x"]) for i in range(40)]
    df = with_row(spark.createDataFrame(docs, "doc_id int, tokens array<string>"))
    model = fit_word2vec(df, size=4, max_iter=2, min_count=2)
    found = {r["word"]: r["embedding"] for r in encode_words(model).collect()}
    assert pulled == [1, None] and set(found) == {"w0", "w1", "w2", "w3", "x"} and all(any(v) for v in found.values())
    monkeypatch.setattr(word_vectors, "with_row", None)  # numbered rows are not written again
    assert model.means(df, "doc_id").count() == 40


def test_descent_of_repeated_and_single_words():
    rng = np.random.default_rng(11)
    vectors, gradient, n = (rng.random(s).astype(np.float32) for s in ((6, 3), (9, 3), 9))
    ids, expect = np.array([4, 1, 4, 0, 2, 4, 1, 5, 4]), vectors.astype(float)
    for i in set(ids):
        expect[i] += 0.5 * gradient[ids == i].sum(axis=0) / np.sqrt(max(n[ids == i].sum(), 1))
    word_vectors._descend(vectors, ids, gradient, n, 0.5)
    assert np.allclose(vectors, expect, rtol=1e-5)
