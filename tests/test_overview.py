import random

import pytest
from pyspark.sql import functions as F

from opinionlens.operators import explore, sentiment
from opinionlens.streaming.overview import MaintainedOverview, _ranges, rank_error

COLUMNS = (
    "id long, cut_content string, keyword1 string, keyword2 string, keyword3 string, dominant_topic int, "
    "sentiment_label string, sentiment_score double"
)


def _rows(n, seed=1):
    rng = random.Random(seed)
    word = lambda: rng.choice(["price", "war", "sun", "tax", None])
    label = lambda: rng.choice(["Negative", "Neutral", "Positive", None])
    score = lambda: rng.choice([None, float("nan"), rng.random(), rng.random(), 0.5])
    # Topic 0 holds a third of all rows; topic 9 has no score.
    topic = lambda: rng.choice([0, 0, 1, 2, None, 3])
    rows = [(i, f"t{i}", word(), word(), word(), topic(), label(), score()) for i in range(n)]
    return rows + [(n, "last", "sun", None, None, 9, "Neutral", None)]


def _same(overview, whole):
    found = overview.hot_keywords(4).collect()
    assert found == explore.hot_keywords(whole, n=4).collect()
    assert overview.hot_keywords(None, drop_null=True).count() == explore.hot_keywords(whole, n=None, drop_null=True).count()
    key = lambda r: r[0]
    assert sorted(overview.sentiment_by_topic().collect(), key=key) == sorted(sentiment.sentiment_by_topic(whole).collect(), key=key)
    assert overview.sample_comments(5).collect() == explore.sample_comments(whole, 5).collect()


def test_batches_replays_and_snapshots(spark, tmp_path):
    whole = spark.createDataFrame(_rows(400), COLUMNS).cache()
    overview = MaintainedOverview(spark, str(tmp_path), keep=2)
    batch = lambda b: whole.filter(F.col("id") % 4 == b)
    for b in (0, 1, 1, 2):
        overview.merge(batch(b), b)
    number, deltas, covered = overview._parts()
    assert (number, deltas, covered) == (1, {}, [[0, 2]])
    _same(overview, whole.filter(F.col("id") % 4 < 3))
    # Replays of covered batches and of one after them change nothing.
    for b in (3, 0, 3, 2):
        overview.merge(batch(b), b)
    _same(overview, whole)
    overview.compact()
    overview.compact()
    assert overview._parts() == (2, {}, [[0, 3]])
    _same(overview, whole)


def test_delta_without_a_mark_does_not_count(spark, tmp_path, monkeypatch):
    import opinionlens.streaming.overview as module

    whole = spark.createDataFrame(_rows(50), COLUMNS)
    overview = MaintainedOverview(spark, str(tmp_path))

    def lost(*args):
        raise OSError("driver lost")

    monkeypatch.setattr(module, "put_once", lost)
    with pytest.raises(OSError):
        overview.merge(whole, 0)
    monkeypatch.undo()
    assert overview.hot_keywords().count() == 0
    overview.merge(whole, 0)
    _same(overview, whole)


def test_quantiles_within_bound(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, "t", None, None, None, i % 7 and 1, None, rng.gauss(0, 1)) for i in range(20000)]
    whole = spark.createDataFrame(rows, COLUMNS).cache()
    overview = MaintainedOverview(spark, str(tmp_path), k=200)
    for b in range(3):
        overview.merge(whole.filter(F.col("id") % 3 == b), b)
    overview.compact()
    found = {r["dominant_topic"]: r for r in overview.score_quantiles().collect()}
    for topic in (0, 1):
        scores = sorted(r[7] for r in rows if r[5] == topic)
        r = found[topic]
        assert (r["n"], r["low"], r["high"]) == (len(scores), scores[0], scores[-1])
        for name, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75)):
            rank = sum(s <= r[name] for s in scores) / len(scores)
            assert abs(rank - p) <= rank_error(200)


def test_topics_without_scores_and_empty_state(spark, tmp_path):
    overview = MaintainedOverview(spark, str(tmp_path))
    assert overview.hot_keywords().count() == overview.sentiment_by_topic().count() == overview.score_quantiles().count() == 0
    none = spark.createDataFrame([], COLUMNS)
    overview.merge(none, 0)
    assert overview.score_quantiles().count() == 0
    overview.merge(spark.createDataFrame(_rows(30), COLUMNS), 1)
    assert 9 not in {r[0] for r in overview.score_quantiles().collect()}
    assert 9 in {r[0] for r in overview.sentiment_by_topic().collect()}
    with pytest.raises(ValueError):
        overview.sample_comments(1000)


def test_stream(spark, tmp_path):
    whole = spark.createDataFrame(_rows(200), COLUMNS).cache()
    whole.repartition(3).write.parquet(f"{tmp_path}/in")
    overview = MaintainedOverview(spark, f"{tmp_path}/state")
    stream = spark.readStream.schema(whole.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    query = stream.writeStream.foreachBatch(overview.merge).option("checkpointLocation", f"{tmp_path}/check").trigger(availableNow=True).start()
    query.awaitTermination()
    assert len(overview._parts()[1]) == 3
    _same(overview, whole)


def test_ranges():
    assert _ranges([3, 1, 2, 7, 8, 10]) == [[1, 3], [7, 8], [10, 10]]
    assert _ranges([]) == []


def test_batches_of_many_files_count_each_row_once(spark, tmp_path):
    """The stream's batches used to be four files whatever the size, each written by one task."""
    import __spark_entry__ as entry

    ids = list(range(40))
    vectors = [(i, [float(i % 7)] * 64, i % 3) for i in ids]
    tables = {
        "documents": spark.createDataFrame([(i, f"word{i % 3} other") for i in ids], "doc_id long, text string").repartition(12),
        "embeddings": spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int"),
        "events": spark.createDataFrame([(i, i % 2, i / 40) for i in ids], "event_id long, event_type int, value double"),
    }
    for name, table in tables.items():
        table.write.parquet(str(tmp_path / f"{name}.parquet"))
    results, kept = entry._maintained(spark, str(tmp_path))
    assert len(results.inputFiles()) > entry.N_BATCHES
    _, deltas, covered = kept._parts()
    assert not deltas and covered[0][1] < entry.N_BATCHES and covered[0][1] > 0
    expect = {(r["keyword"], r["count"]) for r in explore.hot_keywords(results, n=None).collect()}
    assert {(r["keyword"], r["count"]) for r in kept.hot_keywords(None).collect()} == expect
