import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from opinionlens.operators.emotion import best_run
from opinionlens.operators import epochs
from opinionlens.operators.epochs import Training, batch_gradient, predict, train_epochs, word_slots

PLAN = Training(epochs=3, batches=4, features=64, classes=3)


def loss_of(rows, weights):
    total = 0.0
    for label, slots in rows:
        z = weights[-1] + (weights[slots].mean(axis=0) if slots else 0)
        total += np.log(np.exp(z - z.max()).sum()) + z.max() - z[label]
    return total


def test_gradient_against_differences(spark):
    rnd = np.random.default_rng(4)
    rows = [(int(rnd.integers(3)), [int(x) for x in rnd.integers(0, 6, rnd.integers(0, 5))]) for _ in range(40)]
    weights = rnd.normal(size=(7, 3))
    df = spark.createDataFrame(rows, "label_id int, slots array<int>").repartition(5)
    gradient, loss, n = batch_gradient(df, weights)
    assert n == 40 and loss == pytest.approx(loss_of(rows, weights))
    for i in range(7):
        for c in range(3):
            up, down = weights.copy(), weights.copy()
            up[i, c] += 1e-5
            down[i, c] -= 1e-5
            assert gradient[i, c] == pytest.approx((loss_of(rows, up) - loss_of(rows, down)) / 2e-5, abs=1e-6)


def test_gradient_of_long_texts_and_no_rows(spark, monkeypatch):
    monkeypatch.setattr("opinionlens.operators.epochs.SLICE_WORDS", 10)
    rows = [(0, [1] * 50_000), (1, []), (2, [0, 1, 2]), (1, [3] * 9), (0, [4] * 2)]
    weights = np.arange(18.0).reshape(6, 3) / 7 % 1
    df = spark.createDataFrame(rows, "label_id int, slots array<int>").coalesce(1)
    gradient, loss, n = batch_gradient(df, weights)
    assert n == 5 and loss == pytest.approx(loss_of(rows, weights))
    none, loss, n = batch_gradient(df.limit(0), weights)
    assert not none.any() and loss == 0 and n == 0


def samples(spark):
    words = (["sun", "sea"], ["rain", "wind"], ["snow", "ice"])
    rows = [(i, i % 3, [words[i % 3][i % 2], f"w{i % 7}", words[i % 3][i // 3 % 2]]) for i in range(240)]
    rows += [(500, None, ["sun"]), (501, 0, None), (502, 1, []), (503, 9, ["x"]), (None, 2, ["ice"]), (0, 0, ["sun"])]
    return spark.createDataFrame(rows, "doc_id int, label_id int, tokens array<string>").withColumn("slots", F.lit("x"))


def test_epochs_are_stored_and_the_best_is_kept(spark, tmp_path):
    df = samples(spark)
    train, test = df.filter("doc_id % 5 <> 0 or doc_id is null"), df.filter("doc_id % 5 = 0")
    done = train_epochs(train, test, plan=PLAN, folder=str(tmp_path / "run"))
    table = done.epochs.orderBy("epoch").collect()
    assert [r["epoch"] for r in table] == [1, 2, 3]
    assert table[0]["loss"] > table[-1]["loss"]
    assert table[-1]["accuracy"] > 0.9
    kept = best_run(done.epochs, "accuracy", "epoch").first()
    assert kept["accuracy"] == max(r["accuracy"] for r in table)
    labelled = test.filter("label_id < 3")
    right = predict(labelled, done.best()).filter("prediction_id = label_id").count()
    assert right / labelled.count() == pytest.approx(kept["accuracy"])
    again = train_epochs(train.repartition(3), test, plan=PLAN)
    assert np.allclose(again.weights(3), done.weights(3), atol=1e-6)


def test_nothing_to_learn_or_to_test(spark):
    none = samples(spark).limit(0)
    done = train_epochs(none, none, plan=Training(epochs=1, batches=2, features=8, classes=3))
    assert done.epochs.first().asDict() == {"epoch": 1, "loss": None, "accuracy": None, "f1_macro": None}
    assert not done.best().any()


def test_slots_are_in_range(spark):
    slots = samples(spark).select(F.explode(word_slots("tokens", 64)).alias("s")).agg(F.min("s"), F.max("s")).first()
    assert 0 <= slots[0] <= slots[1] < 64


def test_prediction_works_on_bounded_slices(monkeypatch):
    rnd = np.random.default_rng(4)
    weights = rnd.normal(size=(33, 3))
    lists = pd.Series([rnd.integers(0, 32, n).astype(np.int32) for n in (3, 0, 50, 7, 7, 0, 9, 1)])
    wanted = [int((weights[x].sum(axis=0) / max(1, len(x)) + weights[-1]).argmax()) for x in lists]
    seen, logits = [], epochs._logits
    monkeypatch.setattr(epochs, "SLICE_WORDS", 10)
    monkeypatch.setattr(epochs, "_logits", lambda slots, *rest: seen.append(len(slots)) or logits(slots, *rest))
    assert epochs._best(lists, weights).tolist() == wanted and epochs._best(lists[:0], weights).tolist() == []
    assert max(n for n in seen if n != 50) <= 10 and sum(seen) == 77
