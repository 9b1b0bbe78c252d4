"""Training of a classifier epoch by epoch: evaluation and stored weights after each, the best one kept.

The classifier is multinomial logistic regression on the mean of a text's
hashed words. Each step sums the gradient of one mini-batch in Spark: tasks add
up their rows in an array of fixed size, and the sums meet by slot. The driver
holds the weights alone, ``features`` by ``classes`` numbers whatever the data.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opinionlens.functions.text import NO_TOKENS
from opinionlens.operators.emotion import EMOTIONS, best_run, classification_metrics
from opinionlens.session import shared_dir

#: Words that numpy works on at once in a task; a longer text makes a slice of its own.
SLICE_WORDS = 500_000
#: Of the moving averages of gradients and of their squares, as the optimiser Adam has them.
AVERAGES = (0.9, 0.999)


@dataclass(frozen=True)
class Training:
    epochs: int = 3
    batches: int = 8  # mini-batches, and so steps, of an epoch
    rate: float = 0.5
    decay: float = 0.01
    features: int = 1 << 16
    classes: int = len(EMOTIONS)


def word_slots(tokens: str, features: int) -> Column:
    """Slot of each word; null lists have none."""
    words = F.coalesce(F.col(tokens), F.expr(NO_TOKENS))
    return F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(features)).cast("int"))


def _logits(slots: np.ndarray, rows: np.ndarray, sizes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Mean weights of each text's slots, and the bias in the last row of ``weights``."""
    sums = [np.bincount(rows, weights[slots, c], len(sizes)) for c in range(weights.shape[1])]
    return np.stack(sums, axis=1) / np.maximum(sizes, 1)[:, None] + weights[-1]


def _slices(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of lists, of these sizes, of at most ``SLICE_WORDS`` words."""
    at, held = 0, 0
    for i, n in enumerate(sizes):
        if i > at and held + n > SLICE_WORDS:
            yield at, i
            at, held = i, 0
        held += n
    if len(sizes):
        yield at, len(sizes)


def batch_gradient(rows: DataFrame, weights: np.ndarray) -> tuple[np.ndarray, float, int]:
    """Summed gradient of the cross entropy, the summed loss and the count of rows (label_id, slots).

    Rows of no table give zeros. Tasks send their touched slots, at most one
    row each, and Spark adds them up.
    """
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(weights)  # of fixed size
    classes = weights.shape[1]
    names = ["slot", *[f"g{c}" for c in range(classes)], "loss", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        total, loss, n = np.zeros_like(held), 0.0, 0
        for batch in batches:
            for a, b in _slices(np.diff(batch["slots"].offsets.to_numpy())):
                lists = batch["slots"].slice(a, b - a)
                label = batch["label_id"].slice(a, b - a).to_numpy(zero_copy_only=False).astype(np.int64)
                sizes = np.diff(lists.offsets.to_numpy())
                slots, at = lists.flatten().to_numpy(), np.repeat(np.arange(b - a), sizes)
                logits = _logits(slots, at, sizes, held)
                logits -= logits.max(axis=1, keepdims=True)
                error = np.exp(logits)
                error /= error.sum(axis=1, keepdims=True)
                loss -= float(np.log(np.maximum(error[np.arange(b - a), label], 1e-300)).sum())
                error[np.arange(b - a), label] -= 1
                share = error / np.maximum(sizes, 1)[:, None]
                for c in range(classes):
                    total[:-1, c] += np.bincount(slots, share[at, c], len(held) - 1)
                total[-1] += error.sum(axis=0)
                n += b - a
        touched = np.flatnonzero(total.any(axis=1))
        touched = np.union1d(touched, [len(held) - 1])  # the bias carries loss and count
        last = touched == len(held) - 1
        columns = [touched.astype(np.int64), *total[touched].T, np.where(last, loss, 0.0), np.where(last, n, 0)]
        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], names=names)

    schema = ", ".join(["slot bigint", *[f"g{c} double" for c in range(classes)], "loss double", "n bigint"])
    sums = rows.select("label_id", "slots").mapInArrow(run, schema).groupBy("slot").agg(*[F.sum(c).alias(c) for c in names[1:]])
    found = sums.toArrow()  # at most a row for each slot
    shared.unpersist()
    gradient = np.zeros_like(weights)
    at = found["slot"].to_numpy()
    for c in range(classes):
        gradient[at, c] = found[f"g{c}"].to_numpy()
    return gradient, float(np.sum(found["loss"].to_numpy())), int(np.sum(found["n"].to_numpy()))


def _best(lists: pd.Series, weights: np.ndarray) -> np.ndarray:
    """The class with the greatest value for each list of slots."""
    given, found = lists.to_numpy(), [np.zeros(0, np.int64)]
    lengths = np.array([len(own) for own in given], np.int64)
    for a, b in _slices(lengths):
        slots, rows = np.concatenate(given[a:b]).astype(np.int64), np.repeat(np.arange(b - a), lengths[a:b])
        found.append(_logits(slots, rows, lengths[a:b], weights).argmax(axis=1))
    return np.concatenate(found)


def predict(df: DataFrame, weights: np.ndarray, tokens: str = "tokens", out: str = "prediction_id") -> DataFrame:
    """Add the class with the greatest value, the first of equal ones; row-local."""
    shared = df.sparkSession.sparkContext.broadcast(weights)

    @F.pandas_udf("int")
    def best(lists: pd.Series) -> pd.Series:
        return pd.Series(_best(lists, shared.value))

    return df.withColumn(out, best(word_slots(tokens, len(weights) - 1)))


def save_weights(spark: SparkSession, weights: np.ndarray, path: str) -> None:
    """One row (slot, weights) for each slot that is not zero."""
    at = np.flatnonzero(weights.any(axis=1))
    rows = pa.table({"slot": pa.array(at), "weights": pa.array(list(weights[at]), pa.list_(pa.float64()))})
    spark.createDataFrame(rows).write.mode("overwrite").parquet(path)


def load_weights(spark: SparkSession, path: str, plan: Training) -> np.ndarray:
    weights = np.zeros((plan.features + 1, plan.classes))
    for row in spark.read.parquet(path).toLocalIterator():
        weights[row["slot"]] = row["weights"]
    return weights


@dataclass(frozen=True)
class Trained:
    """``epochs`` has a row (epoch, loss, accuracy, f1_macro) for each; weights lie under ``folder``."""

    epochs: DataFrame
    folder: str
    plan: Training

    def weights(self, epoch: int) -> np.ndarray:
        return load_weights(self.epochs.sparkSession, f"{self.folder}/epoch={epoch}", self.plan)

    def best(self, metric: str = "accuracy") -> np.ndarray:
        """Weights of the epoch with the best metric, the earliest of equal ones."""
        return self.weights(best_run(self.epochs, metric, "epoch").first()["epoch"])


def train_epochs(
    train: DataFrame,
    test: DataFrame,
    key: str = "doc_id",
    tokens: str = "tokens",
    label_id: str = "label_id",
    plan: Training | None = None,
    folder: str | None = None,
) -> Trained:
    """Train on ``train``; after each epoch evaluate on ``test`` and store the weights.

    A row's mini-batch follows from its key, so a run can be repeated; rows are
    written once, by batch, and a step reads the files of its batch alone.
    Epochs begin with different batches. Rows of either table without a label
    are left out; texts without words have the bias alone; repeated rows each
    count. Without any row to learn from all weights stay zero, and without any
    to test on the metrics are null.
    """
    plan = plan or Training()
    spark = train.sparkSession
    app = spark.sparkContext.applicationId
    folder = folder or f"{shared_dir(spark).rstrip('/')}/opinionlens-{app}/epochs-{uuid.uuid4().hex}"
    labelled = F.col(label_id).between(0, plan.classes - 1)
    batch = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(plan.batches)).cast("int")
    rows = train.filter(labelled).select(F.col(label_id).cast("int").alias("label_id"), word_slots(tokens, plan.features).alias("slots"), batch.alias("batch"))
    rows.write.partitionBy("batch").parquet(f"{folder}/rows")
    rows = spark.read.schema("label_id int, slots array<int>, batch int").parquet(f"{folder}/rows")

    weights = np.zeros((plan.features + 1, plan.classes))
    mean, square = np.zeros_like(weights), np.zeros_like(weights)
    step, results = 0, []
    for epoch in range(1, plan.epochs + 1):
        losses, seen = 0.0, 0
        for i in range(plan.batches):
            own = rows.filter(F.col("batch") == (epoch + i) % plan.batches)
            gradient, loss, n = batch_gradient(own, weights)
            if not n:
                continue
            losses, seen, step = losses + loss, seen + n, step + 1
            gradient /= n
            mean = AVERAGES[0] * mean + (1 - AVERAGES[0]) * gradient
            square = AVERAGES[1] * square + (1 - AVERAGES[1]) * gradient**2
            move = (mean / (1 - AVERAGES[0] ** step)) / (np.sqrt(square / (1 - AVERAGES[1] ** step)) + 1e-8)
            weights = weights - plan.rate * (move + plan.decay * weights)
        save_weights(spark, weights, f"{folder}/epoch={epoch}")
        said = predict(test.filter(labelled).select(label_id, tokens), weights, tokens)
        metrics = classification_metrics(said, label_id, "prediction_id").first()
        results.append((epoch, losses / seen if seen else None, metrics["accuracy"], metrics["f1_macro"]))
    table = spark.createDataFrame(results, "epoch int, loss double, accuracy double, f1_macro double")
    return Trained(table, folder, plan)
