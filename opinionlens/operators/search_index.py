"""Keyword search over a stored trigram index, without a scan of the result table.

The index folder holds two Parquet tables:

``rows``   the result rows in blocks of consecutive ids (one partition folder a
           block), in id order with small pages, so that a few ids cost a few pages;
``grams``  for each three-character gram and block the sorted offsets of the rows
           that hold it, in folders by the gram's bucket. ``block`` and ``n`` are
           the skip entries: counts are read without any list, and lists only of
           the rarest grams. Offsets are small and rising, and stored as differences
           (Parquet's delta encoding).

A keyword's grams name the candidate rows; what is read of these is then searched
like any result table, so results are those of a scan. Keywords without three
characters in a row, and blank ones, scan the rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opinionlens.functions.matching import fold_keyword
from opinionlens.operators.explore import KEYWORD_COLUMNS
from opinionlens.operators.store import append_rows
from opinionlens.session import materialize

GRAM = 3
#: Bits of a character in a gram's number.
CHAR_BITS = 21
#: Text that a task cuts into grams at once.
SLICE_BYTES = 2 << 20
BUCKETS = 16
#: Ids of a block: the most offsets of one list, whatever the share of rows that hold its gram.
BLOCK_IDS = 1 << 16
#: Rarest grams whose lists are intersected.
RAREST = 4
#: Candidates up to this number are named in the scan's filter, in this many ranges of ids.
NAMED_IDS, ID_RANGES = 20_000, 64
#: Candidates that are broadcast after a count; beyond it they are joined by a shuffle.
MAX_BROADCAST_IDS = 2_000_000
PAGE_ROWS = 500


def keyword_grams(keyword: str, literal: bool = False) -> list[str]:
    """Distinct grams that every hit must hold; wildcards end a stretch of characters."""
    folded = fold_keyword(keyword)
    stretches = [folded] if literal else re.split("[%_]", folded)
    return sorted({s[i : i + GRAM] for s in stretches for i in range(len(s) - GRAM + 1)})


def _lists_of(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(gram, block, offsets): sorted offsets of the rows that hold a gram, a list for each slice of the rows of a task.

    Each column is taken for itself; null columns have no grams. ``rows`` has ``id``, ``block``, ``offset`` and the columns.
    """

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        _, first, row = np.unique(batch["id"].to_numpy(), return_index=True, return_inverse=True)
        own, at = [], []
        for name in columns:
            texts = [(b or b"").decode("utf-8", "replace") for b in batch[name].cast(pa.binary()).to_pylist()]
            chars = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.int64)
            chars = np.where((chars >= ord("A")) & (chars <= ord("Z")), chars + 32, chars)  # as fold_ascii
            of = np.repeat(row, [len(t) for t in texts])
            text = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
            inside = text[: 1 - GRAM] == text[GRAM - 1 :]
            own.append(sum(chars[k : len(chars) + 1 - GRAM + k] << CHAR_BITS * (GRAM - 1 - k) for k in range(GRAM))[inside])
            at.append(of[: 1 - GRAM][inside])
        grams, gram = np.unique(np.concatenate(own), return_inverse=True)
        pairs = np.unique(gram << 32 | np.concatenate(at))  # by gram, then by id
        gram, rank = pairs >> 32, pairs & 0xFFFFFFFF
        block, offset = (batch[c].to_numpy()[first] for c in ("block", "offset"))
        starts = np.flatnonzero((np.diff(gram, prepend=-1) != 0) | (np.diff(block[rank], prepend=0) != 0)) if len(pairs) else pairs
        letters = np.stack([grams[gram[starts]] >> CHAR_BITS * k & (1 << CHAR_BITS) - 1 for k in range(GRAM - 1, -1, -1)], axis=1)
        named = letters.astype("<u4").tobytes().decode("utf-32-le")
        ends = pa.array(np.append(starts, len(pairs)).astype(np.int32))
        lists = pa.ListArray.from_arrays(ends, pa.array(offset[rank].astype(np.int32)))
        found = [named[i : i + GRAM] for i in range(0, len(named), GRAM)]
        return pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array(block[rank][starts]), lists], names=["gram", "block", "offsets"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = sum(pc.fill_null(pc.binary_length(batch[c]), 0).to_numpy(zero_copy_only=False).astype(np.int64) for c in columns)
            slices = (np.cumsum(sizes) - sizes) // SLICE_BYTES
            for i in np.unique(slices):  # few rows of some bytes in all, or one long row more
                a, b = np.searchsorted(slices, [i, i + 1])
                yield cut(batch.slice(a, b - a))

    return rows.select("id", "block", "offset", *columns).mapInArrow(run, "gram string, block bigint, offsets array<int>")


def _bucket(gram: Column) -> Column:
    return F.pmod(F.crc32(gram.cast("binary")), F.lit(BUCKETS)).cast("int")


def _ranges(ids: list[int]) -> list[tuple[int, int]]:
    """At most ``ID_RANGES`` ranges that hold all of the sorted ids, cut at the widest gaps."""
    gaps = sorted(range(1, len(ids)), key=lambda i: ids[i] - ids[i - 1], reverse=True)
    cuts = sorted(i for i in gaps[: ID_RANGES - 1] if ids[i] - ids[i - 1] > 1)
    return [(ids[a], ids[b - 1]) for a, b in zip([0, *cuts], [*cuts, len(ids)], strict=True)]


@dataclass(frozen=True)
class SearchIndex:
    """A searchable copy of a result table under ``path``, a folder that all executors share."""

    spark: SparkSession
    path: str
    id_col: str = "id"
    columns: tuple[str, ...] = ("text", *KEYWORD_COLUMNS)
    block_ids: int = BLOCK_IDS

    def add(self, results: DataFrame, stored: bool = False) -> None:
        """Add rows with new ids; ``results`` needs an integer id in every row.

        ``results`` is written first, or with ``stored`` read again from the
        files it comes from, which must hold still.

        Grams are written before rows: a load that ends in between leaves grams
        of rows that do not exist, which no search finds. The same load can then
        be repeated.
        """
        block = F.floor(F.col(self.id_col) / self.block_ids).cast("long")
        offset = (F.col(self.id_col) - block * self.block_ids).cast("int")
        rows = results if stored else materialize(results)
        if not rows.filter(F.col(self.id_col).isNull()).isEmpty():
            raise ValueError(f"rows without {self.id_col} cannot be indexed")
        placed = rows.select(F.col(self.id_col).cast("long").alias("id"), block.alias("block"), offset.alias("offset"), *[F.col(c).cast("string").alias(f"__{c}") for c in self.columns])
        held = _lists_of(placed, [f"__{c}" for c in self.columns])
        # A group is one gram in one block: at most block_ids offsets, in lists that tasks have made. One shuffle serves
        # the groups and the folders: a bucket's groups are dealt out to as many files as keep all partitions busy.
        files = -(-int(self.spark.conf.get("spark.sql.shuffle.partitions")) // BUCKETS)
        dealt = held.withColumn("bucket", _bucket(F.col("gram"))).withColumn("__file", F.pmod(F.xxhash64("gram", "block"), F.lit(files)))
        groups = dealt.repartition("bucket", "__file").groupBy("bucket", "__file", "gram", "block")
        lists = groups.agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("offsets")))).alias("offsets")).drop("__file")
        placed = lists.withColumn("n", F.size("offsets").cast("long")).sortWithinPartitions("bucket", "gram", "block")
        writer = placed.write.mode("append").partitionBy("bucket").option("parquet.writer.version", "PARQUET_2_0")
        writer.option("parquet.page.row.count.limit", str(PAGE_ROWS)).parquet(f"{self.path}/grams")
        rows = rows.withColumn("__block", block)
        rows = rows.repartitionByRange("__block", self.id_col).sortWithinPartitions("__block", self.id_col)
        writer = rows.write.mode("append").partitionBy("__block").option("compression", "zstd")
        writer.option("parquet.page.row.count.limit", str(PAGE_ROWS)).parquet(f"{self.path}/rows")

    def append(self, batch: DataFrame, key: str = "doc_id") -> None:
        """Load a batch as ``append_rows`` does, with ids that go on after the largest one, and index it."""
        self.add(append_rows(self.rows(), batch, key, self.id_col))

    def rows(self) -> DataFrame:
        """All rows, for a scan."""
        return self.spark.read.parquet(f"{self.path}/rows").drop("__block")

    def _lists(self, grams: list[str]) -> DataFrame:
        """Lists of some grams: folders by bucket, then pages by gram, are left out by the scan."""
        table = self.spark.read.parquet(f"{self.path}/grams")
        buckets = [r[0] for r in self.spark.range(1).select(F.explode(F.array_distinct(F.array(*[_bucket(F.lit(g)) for g in grams])))).collect()]
        return table.filter(F.col("bucket").isin(buckets) & F.col("gram").isin(grams))

    def candidates(self, keyword: str, literal: bool = False) -> DataFrame | None:
        """(block, id) of the rows with all grams of the keyword's rarest ones; None where a scan is needed."""
        grams = keyword_grams(keyword, literal)
        if not grams:
            return None
        counts = {r["gram"]: r["n"] for r in self._lists(grams).groupBy("gram").agg(F.sum("n").alias("n")).collect()}
        if len(counts) < len(grams):
            return self.spark.createDataFrame([], "block bigint, id bigint")
        rarest = sorted(grams, key=lambda g: (counts[g], g))[:RAREST]
        # Loads that share a block have a list each, so a gram's lists of a block are united first.
        lists = self._lists(rarest).groupBy("block", "gram").agg(F.flatten(F.collect_list("offsets")).alias("offsets"))
        blocks = lists.groupBy("block").agg(F.collect_list("offsets").alias("lists")).filter(F.size("lists") == len(rarest))
        common = F.aggregate(F.slice("lists", 2, RAREST), F.get("lists", F.lit(0)), lambda a, b: F.array_intersect(a, b))
        return blocks.select("block", F.explode(common).alias("__o")).select("block", (F.col("block") * self.block_ids + F.col("__o")).alias("id"))

    def rows_for(self, keyword: str, literal: bool = False) -> DataFrame:
        """The candidate rows: all hits of the keyword and few others. Search them like the whole table."""
        found = self.candidates(keyword, literal)
        if found is None:
            return self.rows()
        found = materialize(found)
        n = found.count()
        table = self.spark.read.parquet(f"{self.path}/rows")
        if not n:
            return table.drop("__block").filter(F.lit(False))
        if n <= NAMED_IDS:
            named = sorted((r["id"], r["block"]) for r in found.collect())
            ids = [i for i, _ in named]
            inside = [F.col(self.id_col).between(a, b) for a, b in _ranges(ids)]
            near = table.filter(F.col("__block").isin(sorted({b for _, b in named})) & reduce(lambda a, b: a | b, inside))
            return near.filter(F.col(self.id_col).isin(ids)).drop("__block")
        wanted = found.select(F.col("block").alias("__block"), F.col("id").alias(self.id_col))
        wanted = F.broadcast(wanted) if n <= MAX_BROADCAST_IDS else wanted
        return table.join(wanted, ["__block", self.id_col], "left_semi").drop("__block")
