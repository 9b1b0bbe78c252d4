import pytest

from opinionlens.operators.emotion import (
    EMOTIONS,
    best_run,
    classification_metrics,
    decode_labels,
    encode_labels,
    fit_emotion,
    load_model,
    predict_emotion,
    save_model,
    split_labelled,
    train_test_split,
    training_rows,
)


def test_labels_round_trip_and_rejects(spark):
    df = spark.createDataFrame([(n,) for n in (*EMOTIONS, "other", None)], "label string")
    good, bad = split_labelled(encode_labels(df))
    assert {r["label"]: r["label_id"] for r in good.collect()} == {n: i for i, n in enumerate(EMOTIONS)}
    assert {r["label"] for r in bad.collect()} == {"other", None}
    assert all(r["again"] == r["label"] for r in decode_labels(good, out="again").collect())


def test_split_is_repeatable_and_near_a_tenth(spark):
    train, test = train_test_split(spark.range(20_000).withColumnRenamed("id", "doc_id"))
    assert train.count() + test.count() == 20_000
    assert 1_900 < test.count() < 2_100
    big = spark.range(10**12, 10**12 + 2000).withColumnRenamed("id", "doc_id")
    assert 150 < train_test_split(big)[1].count() < 250


def test_macro_f1(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (2, 1)], "label int, prediction int")
    row = classification_metrics(df).first()
    assert row["accuracy"] == pytest.approx(0.5)
    assert row["f1_macro"] == pytest.approx(7 / 18)


def test_best_run_tie(spark):
    df = spark.createDataFrame([(1, 0.5), (2, 0.7), (3, 0.7)], "run int, accuracy double")
    assert best_run(df).first()["run"] == 2


def test_train_save_load(spark, tmp_path):
    rows = [(i, ["sun", "warm"] if i % 2 else ["rain", "cold"], 6 if i % 2 else 0) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id int, tokens array<string>, label_id int")
    model = fit_emotion(df, features=64)
    save_model(model, str(tmp_path / "m"))
    got = predict_emotion(load_model(str(tmp_path / "m")), df).collect()
    assert all(r["predicted_label"] == ("joy" if r["label_id"] else "sad") for r in got)
    assert all(0.5 < r["probability"] <= 1 for r in got)


def test_training_parts_do_not_grow_with_the_input(spark):
    rows = [(i, ["good" if i % 2 else "bad", f"w{i}"], i % 2) for i in range(400)]
    train = spark.createDataFrame(rows, "doc_id bigint, tokens array<string>, label_id int").repartition(100)
    ready = training_rows(train)
    assert ready.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
    assert sorted(map(str, ready.collect())) == sorted(map(str, training_rows(train.coalesce(1)).collect()))
