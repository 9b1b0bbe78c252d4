"""Interpolated modified Kneser-Ney bigram model, counted in Spark.

Words and pairs of words are 64-bit hashes. Pairs are counted in each task,
shuffled in packed columns by their first word (frequent ones are spread by the
second one too), and summed. Each part becomes sorted hash arrays in the shared
folder, which workers map into memory: the pairs found once, the other pairs with
their counts, and the words with all counts that the formulas need. No part of
the model passes through the driver, which sees only totals, counts of counts
and at most ``10 * parts`` frequent words.
"""

from __future__ import annotations

import fcntl
import os
import tempfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinionlens.llm.common import drop_held, release, text_slices, with_fields
from opinionlens.llm.texthash import U64, mix, words_of
from opinionlens.session import materialize, shared_dir

START, END = U64(1), U64(2)
#: Tokens that a task counts before it gives out what it has.
FLUSH_TOKENS = 2_000_000
WORD_FIELDS = ("count", "before", "total", "ones", "twos", "more")


def token_stream(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Context and token hashes of all texts, each with its end token, and the number of their text."""
    words = words_of(texts, lower=True)
    counts = words.counts
    rows = np.repeat(np.arange(len(texts)), counts + 1)
    last = np.cumsum(counts + 1) - 1
    tokens = np.full(len(rows), END)
    inner = np.ones(len(rows), bool)
    inner[last] = False
    tokens[inner] = words.hashes
    contexts = np.full(len(rows), START)
    contexts[1:] = tokens[:-1]
    contexts[last - counts] = START
    return contexts, tokens, rows


def pair_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(first * U64(0x2545F4914F6CDD1D) + second * U64(0x9E3779B97F4A7C15))


def part_of(first: np.ndarray, second: np.ndarray, frequent: np.ndarray, parts: int) -> np.ndarray:
    """Part of the model that a pair belongs to: by its first word, and if that is frequent by both."""
    at = np.minimum(np.searchsorted(frequent, first), len(frequent) - 1)
    key = np.where(frequent[at] == first, mix(first ^ mix(second)), mix(first))
    return ((key >> U64(20)) % U64(parts)).astype(np.int64)


def word_part(words: np.ndarray, parts: int) -> np.ndarray:
    return ((words >> U64(20)) % U64(parts)).astype(np.int64)


def _count_sorted(*columns: np.ndarray, weights: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows, sorted by the first column, then the next, and the sum of their weights."""
    if not len(columns[0]):
        return [c for c in columns], np.zeros(0, np.int64)
    order = np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    new = np.ones(len(order), bool)
    new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    at = np.flatnonzero(new)
    counts = np.diff(np.append(at, len(order))) if weights is None else np.add.reduceat(weights[order], at)
    return [c[at] for c in columns], counts.astype(np.int64)


def count_words(docs: DataFrame, text: str) -> DataFrame:
    """(word, count) over all texts, the end token included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_held()
        for whole in batches:
            for _, texts in text_slices(whole, text):
                words, counts = np.unique(token_stream(texts)[1], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(counts.astype(np.int64))], names=["word", "count"])
        release()

    return docs.select(text).mapInArrow(run, "word bigint, count bigint").groupBy("word").agg(F.sum("count").alias("count"))


def packed_pairs(docs: DataFrame, text: str, frequent: np.ndarray, parts: int) -> DataFrame:
    """Pair counts of each task in packed columns, one row for each part and flush."""
    names = ["part", "contexts", "runs", "words", "counts"]

    def give(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        first, second = (np.concatenate([h[i] for h in held]) for i in (0, 1))
        (part, first, second), counts = _count_sorted(part_of(first, second, frequent, parts), first, second)
        own, begin = np.unique(part, return_index=True)
        rows = []
        for a, b in zip(begin, np.append(begin[1:], len(part))):
            contexts, runs = np.unique(first[a:b], return_counts=True)
            columns = contexts, runs.astype(np.uint32), second[a:b], counts[a:b].astype(np.uint32)
            rows.append([c.tobytes() for c in columns])
        columns = [pa.array(own), *(pa.array([r[i] for r in rows], pa.binary()) for i in range(4))]
        return pa.RecordBatch.from_arrays(columns, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for whole in batches:
            for _, texts in text_slices(whole, text):
                held.append(token_stream(texts)[:2])
                if sum(len(h[0]) for h in held) >= FLUSH_TOKENS:
                    yield give(held)
                    held = []
        if held:
            yield give(held)
        release()

    return docs.select(text).mapInArrow(run, "part bigint, contexts binary, runs binary, words binary, counts binary")


def write_array(folder: str, name: str, values: np.ndarray) -> None:
    """Write raw values to the shared folder under their final name at once; a repeated task writes the same."""
    fs, path = pa.fs.FileSystem.from_uri(folder)
    fs.create_dir(path, recursive=True)
    new = f"{path}/{uuid.uuid4().hex}"
    with fs.open_output_stream(new) as out:
        out.write(values.tobytes())
    if fs.get_file_info(f"{path}/{name}").type == pa.fs.FileType.File:
        fs.delete_file(new)
    else:
        fs.move(new, f"{path}/{name}")


def map_array(folder: str, name: str, dtype) -> np.ndarray:
    """Map an array into memory: in place if the folder is mounted, else from one copy for each machine."""
    fs, path = pa.fs.FileSystem.from_uri(folder)
    source = f"{path}/{name}"
    if not isinstance(fs, pa.fs.LocalFileSystem):
        local = os.path.join(tempfile.gettempdir(), folder.rpartition("/")[2], name)
        os.makedirs(os.path.dirname(local), exist_ok=True)
        with open(f"{local}.lock", "w") as lock:
            fcntl.flock(lock, fcntl.LOCK_EX)
            if not os.path.exists(local):
                pa.fs.copy_files(source, f"{local}.new", source_filesystem=fs, destination_filesystem=pa.fs.LocalFileSystem())
                os.replace(f"{local}.new", local)
        source = local
    return np.memmap(source, dtype, "r") if os.path.exists(source) and os.path.getsize(source) else np.zeros(0, dtype)


@dataclass(frozen=True)
class KneserNey:
    """Where the model's arrays are, and its totals."""

    folder: str
    parts: int
    frequent: tuple[int, ...]
    tokens: int
    vocabulary: int
    pairs: int
    #: Discounts for counts of one, two, and more; of pairs and of the words' numbers of contexts.
    pair_discounts: tuple[float, float, float]
    word_discounts: tuple[float, float, float]
    #: Probability that the discounts of the words leave, and that all words and the unknown one share.
    spare: float


def discounts(n: list[int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from how many things were counted once, twice, three and four times.

    Where a number is missing (small inputs), half a count is taken off.
    """
    n1, n2, n3, n4 = n
    if not (n1 and n2):
        return (0.5, 0.5, 0.5)
    y = n1 / (n1 + 2 * n2)
    raw = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 0.5)
    return tuple(d if 0 < d < i + 1 else 0.5 for i, d in enumerate(raw))


def fit_kneser_ney(docs: DataFrame, where: Column | None = None, text: str = "text", parts: int | None = None) -> KneserNey:
    """Count the model over the whole texts of the rows that ``where`` admits (null texts: the end token alone)."""
    spark = docs.sparkSession
    train = docs.filter(where) if where is not None else docs
    parts = parts or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = f"{shared_dir(spark).rstrip('/')}/opinionlens-{spark.sparkContext.applicationId}/kneser-ney-{uuid.uuid4().hex}"
    folder = folder if ":" in folder else f"file://{folder}"

    words = materialize(count_words(train, text))
    total, vocabulary = words.agg(F.sum("count"), F.count("*")).first()
    total = total or 0
    hot = words.filter(F.col("count") > total // (10 * parts)).select("word").collect()  # fewer than 10 * parts
    frequent = np.sort(np.append(np.array([r[0] for r in hot], np.int64).view(U64), START))

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, ...]]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                runs = np.frombuffer(row["runs"], np.uint32)
                first = np.repeat(np.frombuffer(row["contexts"], U64), runs)
                one = first, np.frombuffer(row["words"], U64), np.frombuffer(row["counts"], np.uint32)
                held.setdefault(row["part"], []).append(one)
        for part in sorted(held):
            columns = [np.concatenate([h[i] for h in held[part]]) for i in range(3)]
            held[part] = []
            (first, second), counts = _count_sorted(columns[0], columns[1], weights=columns[2])
            keys = pair_hash(first, second)
            order = np.argsort(keys, kind="stable")
            once = counts[order] == 1
            write_array(folder, f"once-{part}", keys[order][once])
            write_array(folder, f"keys-{part}", keys[order][~once])
            write_array(folder, f"counts-{part}", counts[order][~once].astype(np.uint32))
            (own,), before = _count_sorted(second)
            (contexts,), sums = _count_sorted(first, weights=counts)
            by_size = [_count_sorted(first, weights=(counts == k).astype(np.int64))[1] for k in (1, 2)]
            several = _count_sorted(first, weights=(counts > 2).astype(np.int64))[1]
            zeros = lambda x: np.zeros(len(x), np.int64)
            rows = [
                (own, before, *([zeros(own)] * 4), *([zeros(own)] * 4)),
                (contexts, zeros(contexts), sums, *by_size, several, *([zeros(contexts)] * 4)),
                # Counts of counts, under a key that is no word.
                (np.zeros(1, U64), *([np.zeros(1, np.int64)] * 5), *(np.array([(counts == k).sum()]) for k in (1, 2, 3, 4))),
            ]
            arrays = [np.concatenate([r[i] for r in rows]) for i in range(10)]
            columns = [pa.array(arrays[0].view(np.int64)), *(pa.array(a.astype(np.int64)) for a in arrays[1:])]
            yield pa.RecordBatch.from_arrays(columns, names=stat_names)

    stat_names = ["word", "before", "total", "ones", "twos", "more", "n1", "n2", "n3", "n4"]
    packed = packed_pairs(train, text, frequent, parts).repartition("part")
    stats = materialize(packed.mapInArrow(reduce, ", ".join(f"{n} bigint" for n in stat_names)))
    summed = stats.filter("word <> 0").groupBy("word").agg(*[F.sum(c).alias(c) for c in WORD_FIELDS[1:]])
    full = materialize(words.join(summed, "word", "full").na.fill(0, list(WORD_FIELDS)))
    sizes = [F.sum((F.col("before") == k).cast("long")) for k in (1, 2, 3, 4)] + [F.sum((F.col("before") > 2).cast("long"))]
    *of_words, w_more, pairs = full.agg(*sizes, F.sum("before")).first()
    of_pairs = stats.filter("word = 0").agg(*[F.sum(f"n{k}") for k in (1, 2, 3, 4)]).first()
    pair_d = discounts([x or 0 for x in of_pairs])
    word_d = discounts([x or 0 for x in of_words])
    pairs = pairs or 0
    taken = word_d[0] * (of_words[0] or 0) + word_d[1] * (of_words[1] or 0) + word_d[2] * (w_more or 0)

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            held.append(np.stack([batch[c].to_numpy() for c in ("word", *WORD_FIELDS)]))
        table = np.concatenate(held, axis=1) if held else np.zeros((1 + len(WORD_FIELDS), 0), np.int64)
        part = word_part(table[0].view(U64), parts)
        for own in np.unique(part):
            mine = table[:, part == own]
            mine = mine[:, np.argsort(mine[0].view(U64), kind="stable")]
            write_array(folder, f"words-{own}", mine[0].view(U64))
            write_array(folder, f"values-{own}", mine[1:].T)
        yield pa.RecordBatch.from_arrays([pa.array([table.shape[1]], pa.int64())], names=["n"])

    numbered = full.withColumn("__part", F.shiftrightunsigned("word", 20) % parts)  # as word_part
    numbered.repartition("__part").drop("__part").mapInArrow(store, "n bigint").agg(F.sum("n")).collect()
    spare = taken / pairs if pairs else 1.0
    return KneserNey(folder, parts, tuple(int(x) for x in frequent), int(total), int(vocabulary), int(pairs), pair_d, word_d, spare)


class Model:
    """The arrays of a model, mapped into memory when first asked for."""

    def __init__(self, model: KneserNey):
        self.model = model
        self.frequent = np.array(model.frequent, U64)
        self.arrays: dict[str, np.ndarray] = {}

    def array(self, name: str, dtype) -> np.ndarray:
        if name not in self.arrays:
            self.arrays[name] = map_array(self.model.folder, name, dtype)
        return self.arrays[name]

    def words(self, words: np.ndarray) -> np.ndarray:
        """Rows of ``WORD_FIELDS``; zeros for unknown words."""
        out = np.zeros((len(words), len(WORD_FIELDS)), np.int64)
        part = word_part(words, self.model.parts)
        for own in np.unique(part):
            stored = self.array(f"words-{own}", U64)
            if not len(stored):
                continue
            values = self.array(f"values-{own}", np.int64).reshape(-1, len(WORD_FIELDS))
            mine = np.flatnonzero(part == own)
            at = np.minimum(np.searchsorted(stored, words[mine]), len(stored) - 1)
            found = stored[at] == words[mine]
            out[mine[found]] = values[at[found]]
        return out

    def pairs(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Counts of pairs; 0 for unknown ones."""
        out = np.zeros(len(first), np.int64)
        part = part_of(first, second, self.frequent, self.model.parts)
        keys = pair_hash(first, second)
        order = np.lexsort((keys, part))  # each array is walked from one end to the other
        bounds = np.searchsorted(part[order], np.arange(self.model.parts + 1))
        for own in np.unique(part):
            mine = order[bounds[own] : bounds[own + 1]]
            for name in ("once", "keys"):
                stored = self.array(f"{name}-{own}", U64)
                if not len(stored):
                    continue
                at = np.minimum(np.searchsorted(stored, keys[mine]), len(stored) - 1)
                found = stored[at] == keys[mine]
                out[mine[found]] = 1 if name == "once" else self.array(f"counts-{own}", np.uint32)[at[found]]
        return out

    def log10(self, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 probability of each pair's second word after its first, and the second word's count."""
        m = self.model
        own, place = np.unique(np.concatenate([first, second]), return_inverse=True)
        table = self.words(own).astype(float)
        count, before, total, ones, twos, more = table.T
        at_first, at_second = place[: len(first)], place[len(first) :]
        word_d, pair_d = np.array([0, *m.word_discounts]), np.array([0, *m.pair_discounts])
        lower = (before - word_d[np.minimum(before, 3).astype(int)]) / max(m.pairs, 1) + m.spare / (m.vocabulary + 1)
        left = (pair_d[1] * ones + pair_d[2] * twos + pair_d[3] * more) / np.maximum(total, 1)
        left[total == 0] = 1.0  # an unseen context leaves all to the words alone
        pairs = self.pairs(first, second)
        higher = (pairs - pair_d[np.minimum(pairs, 3)]) / np.maximum(total, 1)[at_first]
        return np.log10(higher + left[at_first] * lower[at_second]), count[at_second]


def score_texts(docs: DataFrame, model: KneserNey, text: str = "text") -> DataFrame:
    """Add n_tokens, n_known, train_tokens, base_score, score and perplexity to every row.

    Null and empty texts have the end token alone. Unknown words share one
    place in the vocabulary. Repeated rows are each scored; an empty table gives
    an empty one; a model of no rows gives every token the probability 1.
    Columns of ``docs`` named like an added one are replaced.
    """
    added = {"n_tokens": "bigint", "n_known": "bigint", "train_tokens": "bigint", "base_score": "double", "score": "double", "perplexity": "double"}
    names = [c for c in docs.columns if c not in added]
    schema = with_fields(docs.select(*names).schema, **added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(model)  # mapped anew in each task: the pages stay in the system's cache, not in the worker
        for whole in batches:
            for batch, texts in text_slices(whole, text):
                contexts, tokens, rows = token_stream(texts)
                # A pair that comes twice in the slice is looked up once.
                key = pair_hash(contexts, tokens)
                _, at, place = np.unique(key, return_index=True, return_inverse=True)
                logs, counts = own.log10(contexts[at], tokens[at])
                logs, counts = logs[place], counts[place]
                base = np.log10((counts + 1) / (model.tokens + model.vocabulary + 1))
                n = batch.num_rows
                totals = np.bincount(rows, minlength=n)
                scores = np.bincount(rows, logs, n)
                columns = {
                    "n_tokens": totals.astype(np.int64),
                    "n_known": np.bincount(rows, counts > 0, n).astype(np.int64),
                    "train_tokens": np.full(n, model.tokens, np.int64),
                    "base_score": np.bincount(rows, base, n),
                    "score": scores,
                    "perplexity": 10 ** (-scores / totals),
                }
                arrays = [*(batch[c] for c in names), *map(pa.array, columns.values())]
                yield pa.RecordBatch.from_arrays(arrays, names=[*names, *added])
        release()

    return docs.select(*names).mapInArrow(run, schema)
