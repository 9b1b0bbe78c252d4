"""URL rules kept as sorted digest arrays that workers map into memory.

A rule is a host and the start of a path, such as ``example.com/en/``. It fits
its host and all subdomains if the URL's path starts with the rule's; of several
the longest decides. The rules are sorted by the 64-bit hash of their string, in
Spark, and written in the shared folder. Each executor fetches the files once
(``SparkContext.addFile``), turns them into plain arrays on its disk and maps
those; memory holds the pages that are probed. The hashes of all rule strings a
URL could fit are looked up by one binary search for a whole batch, and hits are
confirmed against the stored strings.
"""

from __future__ import annotations

import fcntl
import os
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinionlens.llm.common import with_fields, worker_held
from opinionlens.session import materialize

#: URLs probed at once.
ROWS_AT_ONCE = 20_000
_UPPER = {i: i + 32 for i in range(65, 91)}
_PARTS = re.compile(r"://([^/?#]*)([^?#]*)")


@dataclass(frozen=True)
class DigestFiles:
    """Names of the store's files as executors see them, and the path lengths of its rules."""

    names: tuple[str, ...]
    path_lengths: tuple[int, ...]


def rule_rows(spark: SparkSession, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """Rules given as (verdict, host + path start) pairs."""
    return spark.createDataFrame(list(rules), "verdict string, rule string")


def build_digest_store(rules: DataFrame, files: int | None = None) -> DigestFiles:
    """Write rules (verdict, rule) as sorted digest arrays and hand the files to the executors.

    A rule string without ``/`` gets one at its end, since a path starts with
    it; its host counts in lower case. Null and blank rules are left out. Of
    equal rules ``block`` wins. Only file names and the distinct path lengths
    (at most ``MAX_PATH_LENGTHS``) reach the driver.
    """
    spark = rules.sparkSession
    host = F.translate(F.substring_index("rule", "/", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.when(F.instr("rule", "/") > 0, F.expr("substring(rule, instr(rule, '/'))")).otherwise(F.lit("/"))
    clean = (
        rules.filter(F.trim("rule") != "")
        .select(F.concat(host, path).alias("rule"), F.char_length(path).alias("path_length"), "verdict")
        .groupBy("rule", "path_length")
        .agg(F.max(F.col("verdict") == "block").alias("block"))
    )
    keyed = clean.withColumn("key", F.xxhash64("rule"))
    parts = files or spark.sparkContext.defaultParallelism
    stored = materialize(keyed.repartitionByRange(parts, "key").sortWithinPartitions("key", "rule"))
    lengths = [r[0] for r in stored.select("path_length").distinct().limit(MAX_PATH_LENGTHS + 1).collect()]
    if len(lengths) > MAX_PATH_LENGTHS:
        raise ValueError(f"rules have over {MAX_PATH_LENGTHS} different path lengths")
    names = []
    for uri in stored.inputFiles():
        spark.sparkContext.addFile(uri)
        names.append(uri.rpartition("/")[2])
    return DigestFiles(tuple(sorted(names)), tuple(sorted(lengths)))


#: Different path lengths of the rules; each is probed for each host suffix of a URL.
MAX_PATH_LENGTHS = 10_000


class DigestArrays:
    """The store's files of one executor, mapped into memory."""

    def __init__(self, names: Sequence[str]):
        self.parts = [self._open(SparkFiles.get(n)) for n in names]

    @staticmethod
    def _open(source: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Turn the Parquet file into raw arrays beside it, once for each executor."""
        with open(f"{source}.lock", "w") as lock:
            fcntl.flock(lock, fcntl.LOCK_EX)
            if not os.path.exists(f"{source}.done"):
                with open(f"{source}.keys", "wb") as k, open(f"{source}.ends", "wb") as e, open(f"{source}.text", "wb") as t, open(f"{source}.block", "wb") as b:
                    end = 0
                    for batch in pq.ParquetFile(source).iter_batches(65_536, columns=["key", "rule", "block"]):
                        rules = [x.encode() for x in batch["rule"].to_pylist()]
                        ends = end + np.cumsum([len(x) for x in rules], dtype=np.int64)
                        end = int(ends[-1]) if len(ends) else end
                        k.write(batch["key"].to_numpy().tobytes())
                        e.write(ends.tobytes())
                        t.write(b"".join(rules))
                        b.write(np.asarray(batch["block"].to_pylist(), np.uint8).tobytes())
                open(f"{source}.done", "w").close()
        load = lambda kind, dtype: np.memmap(f"{source}.{kind}", dtype, "r") if os.path.getsize(f"{source}.{kind}") else np.zeros(0, dtype)
        return load("keys", np.int64), load("ends", np.int64), load("text", np.uint8), load("block", np.uint8)

    def find(self, keys: np.ndarray, strings: Sequence[bytes]) -> np.ndarray:
        """1 for a block rule, 0 for an allow rule, -1 where the string is no rule."""
        found = np.full(len(keys), -1, np.int8)
        for stored, ends, text, block in self.parts:
            if not len(stored):
                continue
            at = np.searchsorted(stored, keys)
            inside = np.flatnonzero(at < len(stored))
            for i in inside[stored[at[inside]] == keys[inside]]:
                place = at[i]
                while place < len(stored) and stored[place] == keys[i]:  # equal hashes lie side by side
                    start = ends[place - 1] if place else 0
                    if text[start : ends[place]].tobytes() == strings[i]:
                        found[i] = block[place]
                        break
                    place += 1
        return found


def split_url(url: str | None) -> tuple[str, str]:
    """Host, with A-Z lower-cased, and path; both empty for null or without ``://``."""
    parts = _PARTS.search(url) if url else None
    return (parts[1].translate(_UPPER), parts[2]) if parts else ("", "")


def fitting_rules(host: str, path: str, lengths: Sequence[int]) -> Iterator[str]:
    """Every string that a rule fitting the URL could have."""
    if not host:
        return
    tails = [host]
    while "." in tails[-1]:
        tails.append(tails[-1].partition(".")[2])
    for n in lengths:
        if n <= len(path):
            for tail in tails:
                yield tail + path[:n]


def _key(text: bytes) -> int:
    return xxhash.xxh64_intdigest(text, 42)


def filter_urls(pages: DataFrame, store: DigestFiles, url: str = "url", default: str = "allow") -> DataFrame:
    """Add host, path, rule and verdict to every row.

    Null URLs and those without ``://`` have an empty host and path, no rule,
    and the verdict ``default``, as have URLs that no rule fits. Repeated rows
    are each judged; an empty table gives an empty one. Columns of ``pages``
    named like an added one are replaced.
    """
    names = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    kept = pages.select(*names)
    schema = with_fields(kept.schema, host="string", path="string", rule="string", verdict="string")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = worker_held(("digests", *store.names), lambda: DigestArrays(store.names))
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(at, ROWS_AT_ONCE)
                parts = [split_url(x) for x in batch[url].to_pylist()]
                candidates = [list(fitting_rules(h, p, store.path_lengths)) for h, p in parts]
                distinct = {c: i for i, c in enumerate({c for cs in candidates for c in cs})}
                strings = [c.encode() for c in distinct]
                keys = np.fromiter((_key(s) for s in strings), np.uint64, len(strings)).view(np.int64)
                block = arrays.find(keys, strings) if len(strings) else np.zeros(0, np.int8)
                rules, verdicts = [], []
                for cs in candidates:
                    fit = max((c for c in cs if block[distinct[c]] >= 0), key=lambda c: (len(c), c), default=None)
                    rules.append(fit)
                    verdicts.append(default if fit is None else "block" if block[distinct[fit]] else "allow")
                new = [[h for h, _ in parts], [p for _, p in parts], rules, verdicts]
                names = [*batch.schema.names, "host", "path", "rule", "verdict"]
                yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(x, pa.string()) for x in new)], names=names)

    return kept.mapInArrow(judge, schema)
