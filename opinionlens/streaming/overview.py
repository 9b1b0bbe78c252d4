"""Overview of a growing result table, kept up batch by batch and never recounted.

Each batch leaves a delta: counts by keyword, labels and a quantile sketch by
topic, and its first comments. The overview sums the deltas, so a view reads
rows in proportion to keywords and topics, not to comments. A delta counts once
its commit mark exists, and a batch has one mark whatever the number of its
replays, so every batch counts exactly once. Old deltas are summed into a
snapshot, which names the batches it covers.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinionlens.operators.explore import KEYWORD_COLUMNS, hot_keywords
from opinionlens.operators.marks import exists, put_once, texts
from opinionlens.operators.sentiment import LABELS, sentiment_by_topic
from opinionlens.session import materialize

#: Size of a topic's sketch, a few kilobytes whatever the topic's rows.
SKETCH_K = 1000
#: Deltas that a view sums before they are put into a snapshot.
KEEP = 32
#: Comments with the smallest ids that are kept.
FIRST = 100

_TABLES = {
    "keywords": "keyword string, count bigint",
    "topics": "topic int, " + ", ".join(f"{name} bigint" for name in LABELS) + ", n bigint, low double, high double, sketch binary",
    "comments": "id bigint, cut_content string",
}


def rank_error(k: int = SKETCH_K) -> float:
    """Bound of a sketch quantile's error in rank, as a share of the rows: twice what 99 of 100 quantiles keep."""
    return 2 * 2.296 / k**0.9021


@dataclass(frozen=True)
class MaintainedOverview:
    """State under ``path``, a folder that all executors share.

    ``merge`` is a ``foreachBatch`` function. Batches of one id must hold the
    same rows, as replays of a stream do. Scores that are null or NaN enter no
    sketch; rows without a topic enter keywords and comments only.
    """

    spark: SparkSession
    path: str
    topic: str = "dominant_topic"
    k: int = SKETCH_K
    keep: int = KEEP

    def merge(self, batch: DataFrame, batch_id: int) -> None:
        mark = f"{self.path}/commits/{batch_id}"
        if exists(self.spark, mark):
            return
        columns = ("id", "cut_content", *KEYWORD_COLUMNS, self.topic, "sentiment_label", "sentiment_score")
        rows = materialize(batch.select(*columns))
        score = F.when(~F.isnan("sentiment_score"), F.col("sentiment_score").cast("double"))
        scores = rows.filter(F.col(self.topic).isNotNull()).withColumn("__score", score)
        sketches = (
            scores.filter(F.col("__score").isNotNull())
            .groupBy(self.topic)
            .agg(
                F.count("*").alias("n"),
                F.min("__score").alias("low"),
                F.max("__score").alias("high"),
                F.kll_sketch_agg_double("__score", F.lit(self.k)).alias("sketch"),
            )
        )
        # Both sides have one row a topic.
        topics = sentiment_by_topic(rows, self.topic).join(sketches, self.topic, "left").withColumnRenamed(self.topic, "topic")
        folder = f"deltas/{batch_id}-{uuid.uuid4().hex}"
        self._write(
            folder,
            {
                "keywords": hot_keywords(rows, n=None),
                "topics": topics,
                "comments": rows.orderBy("id").limit(FIRST).select("id", "cut_content"),
            },
        )
        if put_once(self.spark, mark, json.dumps({"batch": batch_id, "folder": folder})):
            _, deltas, _ = self._parts()
            if len(deltas) > self.keep:
                self.compact()

    def compact(self) -> None:
        """Sum the snapshot and all deltas into a new snapshot; of two at a time one is kept."""
        number, deltas, covered = self._parts()
        if not deltas:
            return
        folder = f"snapshots/{number + 1}-{uuid.uuid4().hex}"
        self._write(folder, {"keywords": self._keywords(), "topics": self._topics(), "comments": self._comments(FIRST)})
        done = _ranges(sorted(deltas) + [b for low, high in covered for b in range(low, high + 1)])
        put_once(self.spark, f"{self.path}/marks/{number + 1}", json.dumps({"number": number + 1, "folder": folder, "covered": done}))

    def hot_keywords(self, n: int | None = 20, drop_null: bool = False) -> DataFrame:
        """As ``explore.hot_keywords`` over all merged rows."""
        counts = self._keywords()
        if drop_null:
            counts = counts.filter(F.col("keyword").isNotNull())
        return counts if n is None else counts.orderBy(F.desc("count"), F.asc_nulls_last("keyword")).limit(n)

    def sentiment_by_topic(self) -> DataFrame:
        """As ``sentiment.sentiment_by_topic`` over all merged rows."""
        return self._topics().select(F.col("topic").alias(self.topic), *LABELS)

    def sample_comments(self, n: int = 10) -> DataFrame:
        """As ``explore.sample_comments`` over all merged rows; ``n`` up to ``FIRST``."""
        if n > FIRST:
            raise ValueError(f"only the first {FIRST} comments are kept")
        return self._comments(n)

    def score_quantiles(self, at: Sequence[tuple[str, float]] = (("q1", 0.25), ("median", 0.5), ("q3", 0.75))) -> DataFrame:
        """Rows, exact ends and quantiles of each topic's scores, within ``rank_error(k)`` in rank."""
        found = [F.kll_sketch_get_quantile_double("sketch", F.lit(p)).alias(name) for name, p in at]
        return self._topics().filter(F.col("n") > 0).select(F.col("topic").alias(self.topic), "n", "low", *found, "high")

    def _keywords(self) -> DataFrame:
        return self._read("keywords").groupBy("keyword").agg(F.sum("count").alias("count"))

    def _topics(self) -> DataFrame:
        """One row a topic; tasks merge their sketches before the shuffle."""
        labels = [F.sum(name).alias(name) for name in LABELS]
        return self._read("topics").groupBy("topic").agg(
            *labels,
            F.sum("n").alias("n"),
            F.min("low").alias("low"),
            F.max("high").alias("high"),
            F.kll_merge_agg_double("sketch", F.lit(self.k)).alias("sketch"),
        )

    def _comments(self, n: int) -> DataFrame:
        return self._read("comments").orderBy("id").limit(n)

    def _write(self, folder: str, tables: dict[str, DataFrame]) -> None:
        for name, table in tables.items():
            kept = [f"CAST(`{c.split()[0]}` AS {c.split()[1]}) AS `{c.split()[0]}`" for c in _TABLES[name].split(", ")]
            table.selectExpr(*kept).write.parquet(f"{self.path}/{folder}/{name}")

    def _parts(self) -> tuple[int, dict[int, str], list[list[int]]]:
        """Number of the newest snapshot, folders of the batches it lacks, and ranges of those it covers."""
        newest = max(self._marks("marks"), key=lambda m: m["number"], default={"number": 0, "covered": []})
        inside = lambda b: any(low <= b <= high for low, high in newest["covered"])
        deltas = {m["batch"]: m["folder"] for m in self._marks("commits") if not inside(m["batch"])}
        return newest["number"], deltas, newest["covered"]

    def _marks(self, folder: str) -> list[dict]:
        return [json.loads(r[0]) for r in texts(self.spark, f"{self.path}/{folder}").collect()]

    def _read(self, name: str) -> DataFrame:
        number, deltas, _ = self._parts()
        folders = list(deltas.values()) + [m["folder"] for m in self._marks("marks") if m["number"] == number]
        if not folders:
            return self.spark.createDataFrame([], _TABLES[name])
        return self.spark.read.schema(_TABLES[name]).parquet(*[f"{self.path}/{f}/{name}" for f in folders])


def _ranges(numbers: Sequence[int]) -> list[list[int]]:
    """Runs of consecutive numbers as [first, last]."""
    out: list[list[int]] = []
    for b in sorted(set(numbers)):
        if out and out[-1][1] == b - 1:
            out[-1][1] = b
        else:
            out.append([b, b])
    return out
