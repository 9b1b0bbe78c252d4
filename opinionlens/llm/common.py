"""Helpers shared by the corpus operators."""

from __future__ import annotations

import contextlib
import ctypes
import sys
import types
from collections.abc import Callable, Iterator
from typing import TypeVar

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

T = TypeVar("T")

#: Bytes of text that numpy works on at once in a Python worker.
SLICE_BYTES = 2 << 20


def read_table(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{table}.parquet")


def worker_cache() -> dict:
    """A dictionary that lives as long as the Python worker process.

    Functions are pickled by value, so a module-level dictionary would be made
    anew for each task. Only small tables of fixed size belong here; what an
    operator has learned or loaded goes through ``worker_held``.
    """
    name = "_opinionlens_worker_cache"
    if name not in sys.modules:
        module = types.ModuleType(name)
        module.entries = {}
        sys.modules[name] = module
    return sys.modules[name].entries


def worker_held(key: tuple, make: Callable[[], T]) -> T:
    """What ``make`` gives, kept for the worker's next tasks until another operator or model begins.

    A worker holds one such object at a time, so its memory does not grow with
    the number of operators a session has run.
    """
    cache = worker_cache()
    held = cache.get("held")
    if held is None or held[0] != key:
        cache.pop("held", None)
        held = None  # the old object is gone before the new one is made
        held = cache["held"] = key, make()
    return held[1]


def drop_held() -> None:
    """Give up what ``worker_held`` keeps, and the memory that Arrow and the C library hold in reserve."""
    worker_cache().pop("held", None)
    release()


def release() -> None:
    """Give free memory back to the system."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)


def text_slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Cut a batch into runs of rows of at most ``limit`` bytes of text.

    A longer text makes a run of its own. The texts come as ``large_string``
    without nulls (null: empty).
    """
    if batch.num_rows == 0:
        return
    texts = pc.fill_null(batch.column(column), "").cast(pa.large_string())
    size = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    at, held = 0, 0
    for i, n in enumerate(size):
        if i > at and held + n > limit:
            yield batch.slice(at, i - at), texts.slice(at, i - at)
            at, held = i, 0
        held += n
    yield batch.slice(at), texts.slice(at)


def crc_remainder(key: Column, divisor: int) -> Column:
    """crc32 of the key as text, modulo ``divisor``; null stays null."""
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(divisor))


def with_fields(schema: StructType, **kinds: str) -> StructType:
    """``schema`` with more fields, whose types are given as in SQL."""
    return StructType([*schema.fields, *(StructField(n, _parse_datatype_string(k)) for n, k in kinds.items())])
