"""Building blocks that keep hot keys and global order off single tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from opinionlens.session import materialize

# A key is hot when it holds more than this share of the rows, so there can
# never be more than 1 / HOT_SHARE hot keys: their broadcast has a fixed bound.
HOT_SHARE = 1.0 / 2000

# Largest keyed side that is broadcast, about 100 bytes a row once hashed.
MAX_BROADCAST_ROWS = 1_000_000


ROW = "__row"


def with_row(df: DataFrame) -> DataFrame:
    """Write ``df`` with a number of its own for each row, whatever its other columns hold."""
    return materialize(df.withColumn(ROW, F.monotonically_increasing_id()))


def with_position(df: DataFrame, order: Sequence[Column | str], out: str = "position") -> DataFrame:
    """Add the exact 0-based global position of each row under ``order``.

    Rows are range-partitioned, so no task sees more than its share even when
    one key holds a third of them. The in-partition position comes from the
    sorted partition itself and the offsets from one count per partition.
    ``order`` must be unique for the result to be repeatable. Range
    partitioning reads its input twice, so materialize a costly one first.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    in_part = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = materialize(
        df.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("__part", F.spark_partition_id())
        .withColumn("__at", in_part)
    )
    # One row per shuffle partition, so the running sum and the broadcast are small.
    sizes = placed.groupBy("__part").agg(F.count("*").alias("__rows"))
    before = W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("__part", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__base"))
    return (
        placed.join(F.broadcast(offsets), "__part")
        .withColumn(out, F.col("__base") + F.col("__at"))
        .drop("__part", "__at", "__base")
    )


def lookup_join(big: DataFrame, small: DataFrame, key: str, spread: str, share: float = HOT_SHARE) -> DataFrame:
    """Left join of a skewed ``big`` side to a ``small`` side unique in ``key``.

    Hot keys of ``big`` (at most 1/share of them) take their match from a
    broadcast; all other keys meet in a shuffle where none exceeds ``share``.
    Rows already served, and rows without a key, carry a scattered key made
    from ``spread`` instead.
    """
    cols = [c for c in small.columns if c != key]
    counts = materialize(big.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("__n")))
    total = counts.agg(F.sum("__n")).first()[0] or 0
    hot_keys = counts.filter(F.col("__n") > total * share).select(key)
    hot = materialize(
        hot_keys.join(small, key, "left").select(
            F.col(key), F.lit(True).alias("__hot"), *[F.col(c).alias(f"__h_{c}") for c in cols]
        )
    )
    served = big.join(F.broadcast(hot), key, "left")
    scattered = F.concat(F.lit("\u0000"), F.pmod(F.xxhash64(spread), F.lit(1 << 20)).cast("string"))
    served = served.withColumn("__key", F.when(F.col("__hot") | F.col(key).isNull(), scattered).otherwise(F.col(key).cast("string")))
    cold = small.select(F.col(key).cast("string").alias("__key"), *[F.col(c).alias(f"__c_{c}") for c in cols])
    out = served.join(cold, "__key", "left")
    picked = [F.when(F.col("__hot"), F.col(f"__h_{c}")).otherwise(F.col(f"__c_{c}")).alias(c) for c in cols]
    return out.select(*big.columns, *picked)


def bounded_join(big: DataFrame, small: DataFrame, key: str, spread: str, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Left join that broadcasts ``small`` only after counting its rows."""
    if small.count() <= max_rows:
        return big.join(F.broadcast(small), key, "left")
    return lookup_join(big, small, key, spread)
