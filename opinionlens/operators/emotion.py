"""Multi-class emotion classifier: labels, split, training, metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinionlens.functions.text import NO_TOKENS, truncate_tokens

# Fixed label order; a label's id is its place in the list.
EMOTIONS = ("sad", "fear", "disgust", "surprise", "angry", "neutral", "joy", "positive")

# Fixed multiplier (about 0.618 * 2^31) and modulus of the split hash.
SPLIT_FACTOR = 1327217885
SPLIT_SPACE = 1 << 31


def _label_map(labels: Sequence[str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in ((n, i) for i, n in enumerate(labels)) for x in pair])


def encode_labels(
    df: DataFrame, label: str = "label", out: str = "label_id", labels: Sequence[str] = EMOTIONS
) -> DataFrame:
    """Label name to id through a literal map; unknown names give null."""
    return df.withColumn(out, F.try_element_at(_label_map(labels), F.col(label)))


def decode_labels(
    df: DataFrame, label_id: str = "label_id", out: str = "label", labels: Sequence[str] = EMOTIONS
) -> DataFrame:
    return df.withColumn(out, F.get(F.array(*[F.lit(n) for n in labels]), F.col(label_id).cast("int")))


def split_labelled(df: DataFrame, label_id: str = "label_id") -> tuple[DataFrame, DataFrame]:
    """Rows with a known label, and the rejected rest."""
    return df.filter(F.col(label_id).isNotNull()), df.filter(F.col(label_id).isNull())


def is_test_row(doc_id: Column | str, fraction: float = 0.1) -> Column:
    """Repeatable membership in the test split, from the row's own id."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    spread = F.pmod(F.pmod(c, F.lit(SPLIT_SPACE)) * F.lit(SPLIT_FACTOR), F.lit(SPLIT_SPACE))
    return spread < F.lit(int(fraction * SPLIT_SPACE))


def train_test_split(df: DataFrame, doc_id: str = "doc_id", fraction: float = 0.1) -> tuple[DataFrame, DataFrame]:
    return df.filter(~is_test_row(doc_id, fraction)), df.filter(is_test_row(doc_id, fraction))


def _words(tokens: str, max_length: int | None) -> Column:
    given = F.coalesce(F.col(tokens), F.expr(NO_TOKENS))
    return given if max_length is None else truncate_tokens(given, max_length)


def training_rows(train: DataFrame, tokens: str = "tokens", label_id: str = "label_id", max_length: int | None = None) -> DataFrame:
    """(words, y) in no more parts than cores, without a shuffle.

    Each part sends a gradient of ``features`` x classes numbers in every
    iteration, whatever it holds, so parts must not grow with the input.
    """
    ready = train.select(_words(tokens, max_length).alias("words"), F.col(label_id).cast("double").alias("y"))
    return ready.coalesce(max(1, train.sparkSession.sparkContext.defaultParallelism))


def fit_emotion(
    train: DataFrame,
    tokens: str = "tokens",
    label_id: str = "label_id",
    max_length: int | None = None,
    features: int = 1 << 18,
    max_iter: int = 20,
    decay: float = 0.01,
) -> PipelineModel:
    """Multinomial logistic regression on hashed token counts of the whole text.

    ``max_length`` reads only so many tokens, for comparison with encoders
    that can take no more. Words share one of ``features`` buckets by chance;
    for vocabularies of that size and above, give more.
    """
    stages = [
        HashingTF(inputCol="words", outputCol="features", numFeatures=features),
        LogisticRegression(
            labelCol="y", featuresCol="features", family="multinomial", maxIter=max_iter, regParam=decay
        ),
    ]
    return Pipeline(stages=stages).fit(training_rows(train, tokens, label_id, max_length))


def predict_emotion(
    model: PipelineModel,
    df: DataFrame,
    tokens: str = "tokens",
    max_length: int | None = None,
    labels: Sequence[str] = EMOTIONS,
) -> DataFrame:
    """Add prediction_id, predicted_label and probability; row-local."""
    given = df.columns
    scored = model.transform(df.withColumn("words", _words(tokens, max_length)))
    out = scored.select(
        *given,
        F.col("prediction").cast("int").alias("prediction_id"),
        F.array_max(vector_to_array("probability")).alias("probability"),
    )
    return decode_labels(out, "prediction_id", "predicted_label", labels)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def classification_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: accuracy and unweighted mean F1 over all classes seen.

    Rows shrink to the confusion table first; the rest works on its cells.
    """
    cells = df.filter(F.col(label).isNotNull() & F.col(prediction).isNotNull()).groupBy(label, prediction)
    cells = cells.agg(F.count("*").alias("n"))
    hit = F.when(F.col(label) == F.col(prediction), F.col("n")).otherwise(0)
    sides = cells.select(
        F.explode(
            F.array(
                F.struct(F.col(label).alias("cls"), hit.alias("tp"), F.col("n").alias("actual"), F.lit(0).alias("said")),
                F.struct(F.col(prediction).alias("cls"), F.lit(0).alias("tp"), F.lit(0).alias("actual"), F.col("n").alias("said")),
            )
        ).alias("s")
    ).select("s.*")
    per_class = sides.groupBy("cls").agg(
        F.sum("tp").alias("tp"), F.sum("actual").alias("actual"), F.sum("said").alias("said")
    )
    f1 = 2.0 * F.col("tp") / (F.col("actual") + F.col("said"))
    return per_class.agg(
        (F.sum("tp") / F.sum("actual")).alias("accuracy"),
        F.avg(f1).alias("f1_macro"),
    )


def best_run(runs: DataFrame, metric: str = "accuracy", run: str = "run") -> DataFrame:
    """The run with the best metric; the earliest wins a tie."""
    return runs.orderBy(F.desc(metric), run).limit(1)
