import math
import os
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from opinionlens.operators import word_topics
from opinionlens.operators.scaling import ROW, with_row
from opinionlens.operators.word_blocks import Block, text_blocks
from opinionlens.operators.word_topics import Shape, fit_word_topics
from opinionlens.session import discard, materialize


def shuffle_files(spark):
    held = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return {f for f in held.split("\n") if "shuffle_" in f and f.endswith(".data")}


def test_shuffles_go_with_the_write(spark):
    """They stayed until the driver collected garbage: all iterations of a model lay on disk at once."""
    before = shuffle_files(spark)
    kept = materialize(spark.range(1000).repartition(3, "id"))
    for _ in range(50):
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.2)
    assert not left and kept.count() == 1000


def test_only_stages_are_discarded(spark, tmp_path):
    kept = materialize(spark.range(10))
    folder = kept.inputFiles()[0].rpartition("/")[0].removeprefix("file://").removeprefix("file:")
    assert os.path.isdir(folder)
    discard(kept)
    assert not os.path.exists(folder)
    spark.range(10).write.parquet(str(tmp_path / "own"))
    with pytest.raises(ValueError, match="not a stage"):
        discard(spark.read.parquet(str(tmp_path / "own")))


def test_blocks_fill_over_partitions(spark):
    """Each partition had a block of its own, however small, and every block moves its words' numbers."""
    df = spark.range(4000).select(F.col("id").alias(ROW), F.array(F.concat(F.lit("w"), F.col("id") % 9), F.lit("x")).alias("tokens")).repartition(200)
    cores = spark.sparkContext.defaultParallelism
    assert text_blocks(df, "tokens", 4, 8000, 0, total=8000).count() <= cores
    assert text_blocks(df, "tokens", 4, 100, 0, total=8000).count() >= 80


@pytest.mark.parametrize("cells", [20, 4_000_000])
def test_updates_of_long_and_short_texts(monkeypatch, cells):
    """Texts are updated beside others of their size, longer ones than a step in pieces."""
    monkeypatch.setattr(word_topics, "CELLS", cells)
    rng = np.random.default_rng(4)
    sizes = np.array([0, 1, 40, 3, 0, 7, 1, 300, 2, 9])
    place = np.concatenate([np.sort(rng.choice(400, n, replace=False)) for n in sizes]).astype(np.int32)
    cnt = rng.integers(1, 6, len(place)).astype(np.uint8)
    counts = rng.random((400, 2)) * 5
    counts[::7] = np.nan  # unknown words
    shape, totals = Shape(2, 3, 400, 0.5, 0.5, 3), np.nansum(counts, axis=0)
    theta, words = word_topics._settle(Block(place, cnt, np.arange(10), sizes), counts, shape, totals)
    likely = (counts + 0.5) / (totals + 400 * 0.5)
    expect, ends = np.zeros_like(counts), np.cumsum(sizes)
    for i, n in enumerate(sizes):
        own = [(p, float(c)) for p, c in zip(place[ends[i] - n : ends[i]], cnt[ends[i] - n : ends[i]]) if not np.isnan(counts[p, 0])]
        mine = np.full(2, sum(c for _, c in own) / 2)
        for last in [False] * 3 + [True]:
            shares = [(p, c * (s := (mine + 0.5) * likely[p]) / s.sum()) for p, c in own]
            if last:
                for p, s in shares:
                    expect[p] += s
            else:
                mine = sum((s for _, s in shares), np.zeros(2))
        assert np.allclose(theta[i], mine, rtol=1e-12)
    assert np.allclose(words, expect, rtol=1e-12)


def test_counts_over_a_byte(spark):
    df = spark.createDataFrame([(0, ["a"] * 700 + ["b"]), (1, ["b"] * 3)], f"{ROW} bigint, tokens array<string>").coalesce(1)
    model = fit_word_topics(df, k=2, passes=2)
    assert model.totals.sum() == pytest.approx(704)


def test_fitted_rows_are_not_cut_again(spark, monkeypatch):
    docs = [(i, ["pay", "work"] * 3 if i % 2 else ["drug", "cost", None] * 3) for i in range(30)] + [(1, []), (None, None)]
    df = with_row(spark.createDataFrame(docs, "doc_id int, tokens array<string>"))
    model = fit_word_topics(df, k=2, passes=5)
    plain = [(r["doc_id"], r["dominant_topic"], r["topic_distribution"]) for r in model.assign(df.drop(ROW)).collect()]
    monkeypatch.setattr(word_topics, "text_blocks", None)
    found = model.assign(df)
    assert ROW not in found.columns
    rows = [(r["doc_id"], r["dominant_topic"], r["topic_distribution"]) for r in found.collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    assert len(rows) == 32 and Counter(r[:2] for r in rows) == Counter(r[:2] for r in plain)
    assert all(math.isclose(a, b) for x, y in zip(sorted(rows, key=key), sorted(plain, key=key)) for a, b in zip(x[2], y[2]))
