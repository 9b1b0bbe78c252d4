"""A stored table whose loads may run side by side and read only the keys they could repeat.

The folder holds

``rows``    the rows, in a folder for each load and, inside it, each partition value;
``keys``    the stored keys in hashed buckets, one sorted file a load and bucket;
``leases``  ranges of ids, each given to one load before it writes;
``log``     commit marks 1, 2, ...: a load's rows count once its mark exists.

A load looks for its keys in the buckets they hash to, takes a range of ids,
writes, and tries for the next mark. Where another load got that mark first, it
looks at that load's keys of the same buckets only: if they share none, it
goes on to the next mark with what it has written, else it leaves the shared
rows out and writes again. A load that fails leaves nothing but unused ids.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from opinionlens.operators.marks import put_once, texts
from opinionlens.operators.scaling import with_position
from opinionlens.operators.store import one_per_key
from opinionlens.session import materialize

#: A bucket's keys are read whole by a load that hits it: some thousands of buckets for 100 TB.
BUCKETS = 64
_BUCKET, _LOAD = "__bucket", "__load"


@dataclass(frozen=True)
class KeyedStore:
    """Rows under ``path``, a folder that all executors share, unique in ``key``, with ids from 1.

    Ids of a load follow its key order and are dense; those of loads that ran
    side by side, failed or were written again leave gaps. ``buckets`` must
    stay the same for one folder. All loads need the same columns.
    """

    spark: SparkSession
    path: str
    key: str = "doc_id"
    id_col: str = "id"
    buckets: int = BUCKETS
    partition_by: str | None = None

    def append(self, batch: DataFrame) -> int:
        """Store rows with new keys and return their number; a repeated load adds nothing.

        A batch with a null key is refused; of rows that share a key one is taken.
        """
        if not batch.filter(F.col(self.key).isNull()).isEmpty():
            raise ValueError(f"rows without {self.key} cannot be stored")
        bucket = F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")
        fresh = materialize(one_per_key(batch, self.key).withColumn(_BUCKET, bucket))
        hit = sorted(r[0] for r in fresh.select(_BUCKET).distinct().collect())  # at most one row a bucket
        loads = self._log()
        self._same_columns(loads, batch)
        fresh = self._without(fresh, loads, hit)
        while n := fresh.count():
            load, low = f"load-{uuid.uuid4().hex}", self._lease(n)
            self._write(fresh, load, low)
            entry = {"load": load, "low": low, "n": n, "schema": self._schema(batch).json()}
            while not self._commit(len(loads) + 1, entry):
                newer = self._log()[len(loads) :]
                loads += newer
                self._same_columns(newer, batch)
                left = self._without(fresh, newer, hit)
                if left.count() < n:
                    fresh = left
                    break
            else:
                return n
        return 0

    def rows(self) -> DataFrame:
        """The rows of all committed loads."""
        loads = self._log()
        if not loads:
            raise ValueError("nothing is stored")
        schema = StructType.fromJson(json.loads(loads[0]["schema"]))
        return self._table("rows", loads, schema).select(*schema.names)

    def _schema(self, batch: DataFrame) -> StructType:
        return StructType([StructField(self.id_col, LongType()), *batch.schema.fields])

    def _same_columns(self, loads: Iterable[dict], batch: DataFrame) -> None:
        names = self._schema(batch).names
        for load in loads:
            stored = StructType.fromJson(json.loads(load["schema"])).names
            if sorted(stored) != sorted(names):
                raise ValueError(f"stored columns are {', '.join(stored)}")

    def _log(self) -> list[dict]:
        """Commit marks without gaps, in their order."""
        return sorted((json.loads(r[0]) for r in texts(self.spark, f"{self.path}/log").collect()), key=lambda m: m["number"])

    def _commit(self, number: int, entry: dict) -> bool:
        return put_once(self.spark, f"{self.path}/log/{number}", json.dumps({"number": number, **entry}))

    def _lease(self, n: int) -> int:
        """First of ``n`` ids that no other load gets."""
        taken = [json.loads(r[0]) for r in texts(self.spark, f"{self.path}/leases").collect()]
        while True:
            low = 1 + max((t["high"] for t in taken), default=0)
            if put_once(self.spark, f"{self.path}/leases/{len(taken) + 1}", json.dumps({"low": low, "high": low + n - 1})):
                return low
            taken = [json.loads(r[0]) for r in texts(self.spark, f"{self.path}/leases").collect()]

    def _table(self, name: str, loads: Iterable[dict], schema: StructType) -> DataFrame:
        base = f"{self.path}/{name}"
        paths = [f"{base}/{_LOAD}={m['load']}" for m in loads]
        return self.spark.read.schema(schema).option("basePath", base).parquet(*paths)

    def _without(self, fresh: DataFrame, loads: list[dict], hit: list[int]) -> DataFrame:
        """Rows whose key no load holds: only the folders of the buckets that were hit are read."""
        if not loads or not hit:
            return fresh
        schema = StructType([fresh.schema[self.key], fresh.schema[_BUCKET]])
        stored = self._table("keys", loads, schema).filter(F.col(_BUCKET).isin(hit)).select(self.key, _BUCKET)
        return materialize(fresh.join(stored, [self.key, _BUCKET], "left_anti"))

    def _write(self, fresh: DataFrame, load: str, low: int) -> None:
        placed = with_position(fresh.select(self.key), [self.key], "__position")
        columns = [c for c in fresh.columns if c != _BUCKET]
        rows = fresh.join(placed, self.key).select((F.col("__position") + low).alias(self.id_col), *columns)
        writer = rows.write.partitionBy(self.partition_by) if self.partition_by else rows.write
        writer.parquet(f"{self.path}/rows/{_LOAD}={load}")
        # Keys are distinct, so the hash deals them out evenly whatever the rows are.
        keys = fresh.select(self.key, _BUCKET).repartition(_BUCKET).sortWithinPartitions(_BUCKET, self.key)
        keys.write.partitionBy(_BUCKET).parquet(f"{self.path}/keys/{_LOAD}={load}")
