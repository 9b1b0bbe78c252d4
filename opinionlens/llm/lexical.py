"""Ranked lexical search with per-term geometric blocking.

Queries are taken in blocks; of each text only the terms that a block asks for are
counted. A task indexes its documents in shards of bounded size: the posting list
of each term is cut into blocks of similar documents (each document goes to the
nearest of some of the list's own documents, by sketches of their vectors), and
each block stores a summary, the greatest value of its documents in every
coordinate that a query could ask for together with the term.

A query opens blocks of its terms' lists in the order of the summaries' bounds and
scores their documents exactly. A block is skipped only if its bound is less than
the score of the last one of the best found so far. All values are 64-bit
integers, so bounds and scores are exact, and no document is missed. The best of
all tasks are merged in two steps.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import IntegralType

from opinionlens.llm.common import drop_held, release, text_slices, with_fields
from opinionlens.llm.texthash import U64, mix
from opinionlens.session import materialize

#: Queries that share one pass over the documents.
QUERY_BLOCK = 500
#: Documents x terms of a shard's table, eight bytes each.
CELLS = 6 << 20
SHARD_DOCUMENTS = 2048
#: Documents of a block; as many coordinates of a summary for each as this allows.
BLOCK_DOCUMENTS = 32
COORDINATES = 2
SKETCH = 64
#: Tables of a first merging step, for each query.
MERGE_GROUPS = 64

# Bytes that terms are made of, A-Z as a-z; all others are blanks.
_TERM_BYTES = bytes(
    i + 32 if 65 <= i <= 90 else i if i >= 128 or 48 <= i <= 57 or 97 <= i <= 122 else 32 for i in range(256)
)


def terms_of(text: bytes) -> list[bytes]:
    """Maximal runs of ASCII letters and digits and of all other characters, A-Z in lower case."""
    return text.translate(_TERM_BYTES).split()


class Queries:
    """Terms of a block of queries, as numbers, and for each term the terms that are asked for with it."""

    def __init__(self, ids: list, counts: list[dict[bytes, int]]):
        self.ids = ids
        self.place = {t: i for i, t in enumerate(sorted({t for own in counts for t in own}))}
        self.terms = [np.array([self.place[t] for t in own], np.int64) for own in counts]
        self.times = [np.array(list(own.values()), np.int64) for own in counts]
        beside: list[set[int]] = [set() for _ in self.place]
        for own in self.terms:
            for t in own:
                beside[t].update(own.tolist())
        self.beside = [np.array(sorted(b), np.int64) for b in beside]
        #: For each query and each of its terms, where the query's terms are among those beside the term.
        self.among = [[np.searchsorted(self.beside[t], own) for t in own] for own in self.terms]


def count_terms(docs: DataFrame, wanted: list[bytes], doc_id: str, text: str) -> DataFrame:
    """(doc_id, n, terms, times): a text's number of terms, and how often it has each wanted one (as packed numbers)."""
    schema = with_fields(docs.select(doc_id).schema, n="bigint", terms="binary", times="binary")
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_held()
        place = {t: i for i, t in enumerate(shared.value)}
        for whole in batches:
            for batch, texts in text_slices(whole, text):
                sizes, terms, times = [], [], []
                for one in texts:
                    own = terms_of(one.as_buffer().to_pybytes())
                    found = sorted((place[t], n) for t, n in Counter(own).items() if t in place)
                    sizes.append(len(own))
                    terms.append(np.array([t for t, _ in found], np.int32).tobytes())
                    times.append(np.array([n for _, n in found], np.int32).tobytes())
                columns = [batch[doc_id], pa.array(sizes, pa.int64()), pa.array(terms, pa.binary()), pa.array(times, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)
        release()

    return docs.select(doc_id, text).mapInArrow(run, schema)


def document_frequencies(counted: DataFrame, n_terms: int) -> np.ndarray:
    """Documents that each wanted term occurs in; one number for each term and task is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms, np.int64)
        for batch in batches:
            for own in batch["terms"]:
                total[np.frombuffer(own.as_buffer(), np.int32)] += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["term", "n"])

    found = np.zeros(n_terms, np.int64)
    for term, n in counted.select("terms").mapInArrow(run, "term bigint, n bigint").groupBy("term").agg(F.sum("n")).collect():
        found[term] = n
    return found


class Shard:
    """Values of some documents, and for each term its posting list in blocks with their summaries."""

    def __init__(self, queries: Queries, values: np.ndarray):
        self.values = values
        n_docs, n_terms = values.shape
        signs = 1 - 2 * (mix(np.arange(n_terms * SKETCH, dtype=U64)) >> U64(63)).astype(np.float32).reshape(n_terms, SKETCH)
        self.sketches = values.astype(np.float32) @ signs
        self.sketches /= np.maximum(np.linalg.norm(self.sketches, axis=1, keepdims=True), 1e-30)
        self.lists = [self._blocks(np.flatnonzero(values[:, t]), beside) for t, beside in enumerate(queries.beside)]

    def _blocks(self, docs: np.ndarray, beside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Documents of a list by block, begin of each block, and summaries over the coordinates ``beside``."""
        size = max(BLOCK_DOCUMENTS, len(beside) // COORDINATES)
        n_blocks = -(-len(docs) // size)
        begins = np.zeros(min(1, n_blocks), np.int64)
        if n_blocks > 1:
            sketches = self.sketches[docs]
            near = np.argmax(sketches @ sketches[np.linspace(0, len(docs) - 1, n_blocks).astype(np.int64)].T, axis=1)
            order = np.argsort(near, kind="stable")
            docs = docs[order]
            begins = np.flatnonzero(np.append(True, np.diff(near[order]) > 0))
        if not n_blocks:
            return docs, begins, np.zeros((0, len(beside)), np.int64)
        return docs, begins, np.maximum.reduceat(self.values[np.ix_(docs, beside)], begins, axis=0)

    def open(self, queries: Queries, q: int, floor: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents that may be among the ``k`` best and their exact scores; ``floor`` is the least score of use."""
        terms, times = queries.terms[q], queries.times[q]
        lists = [self.lists[t] for t in terms]
        bounds = [summary[:, at] @ times for (_, _, summary), at in zip(lists, queries.among[q], strict=True)]
        owner = np.repeat(np.arange(len(lists)), [len(b) for b in bounds])
        inner = np.concatenate([np.arange(len(b)) for b in bounds]) if bounds else np.zeros(0, np.int64)
        bound = np.concatenate(bounds) if bounds else np.zeros(0, np.int64)
        order = np.argsort(-bound, kind="stable")
        seen = np.zeros(len(self.values), bool)
        found, scores = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        at, step = 0, 8
        while at < len(order) and bound[order[at]] >= floor:
            held = []
            for i in order[at : at + step]:
                if bound[i] < floor:
                    break
                docs, begins, _ = lists[owner[i]]
                end = begins[inner[i] + 1] if inner[i] + 1 < len(begins) else len(docs)
                held.append(docs[begins[inner[i]] : end])
            at, step = at + step, 2 * step
            docs = np.unique(np.concatenate(held))
            docs = docs[~seen[docs]]
            seen[docs] = True
            found.append(docs)
            scores.append(self.values[np.ix_(docs, terms)] @ times)
            best = np.concatenate(scores)
            if len(best) >= k:
                floor = max(floor, int(np.partition(best, len(best) - k)[len(best) - k]))
        docs, best = np.concatenate(found), np.concatenate(scores)
        keep = best >= max(floor, 1)
        return docs[keep], best[keep]


def _search(counted: DataFrame, queries: Queries, weights: np.ndarray, n_docs: int, n_terms: int, k: int, doc_id: str, kind: str) -> DataFrame:
    """(item, doc_id, score): the ``k`` best of each task for each query."""
    shared = counted.sparkSession.sparkContext.broadcast((queries.ids, [(a.tolist(), b.tolist()) for a, b in zip(queries.terms, queries.times, strict=True)]))
    width, shard = len(queries.place), max(1, min(SHARD_DOCUMENTS, CELLS // max(1, len(queries.place))))
    type_ = counted.schema[doc_id].dataType
    schema = f"__item {kind}, __query bigint, __doc {type_.simpleString()}, score bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_held()
        ids, pairs = shared.value
        own = Queries(ids, [dict(zip(a, b, strict=True)) for a, b in pairs])
        own.place = range(width)
        best = [(np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64))] * len(ids)  # ids, which are null, scores
        for batch in batches:
            for at in range(0, batch.num_rows, shard):
                part = batch.slice(at, shard)
                doc = part[doc_id].fill_null(0).to_numpy().astype(np.int64)
                no_id = np.asarray(part[doc_id].is_null())
                values = np.zeros((part.num_rows, width), np.int64)
                sizes = part["n"].to_pylist()
                for row, (n, terms, times) in enumerate(zip(sizes, part["terms"], part["times"], strict=True)):
                    terms = np.frombuffer(terms.as_buffer(), np.int32)
                    tf = np.frombuffer(times.as_buffer(), np.int32).astype(np.int64)
                    m = 100 - 75 + 75 * n * n_docs // n_terms  # of any size in Python's integers
                    values[row, terms] = weights[terms] * (1_000_000_000 * tf // (1000 * tf + 8 * m))
                index = Shard(own, values)
                for q, (d, null, s) in enumerate(best):
                    floor = int(s[-1]) if len(s) == k else 1
                    docs, scores = index.open(own, q, floor, k)
                    if len(docs):
                        d, null, s = np.append(d, doc[docs]), np.append(null, no_id[docs]), np.append(s, scores)
                        first = np.lexsort((d, null, -s))[:k]
                        best[q] = d[first], null[first], s[first]
        for q, (d, null, s) in enumerate(best):
            columns = [pa.array([ids[q]] * len(d)), pa.array(np.full(len(d), q)), pa.array(d, mask=null), pa.array(s)]
            columns = [c.cast(t) for c, t in zip(columns, arrow, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=["__item", "__query", "__doc", "score"])
        release()

    out = counted.sparkSession.createDataFrame([], schema).schema
    arrow = to_arrow_schema(out).types
    return counted.mapInArrow(run, out)


def search(
    docs: DataFrame, items: DataFrame, k: int = 10, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text", query_block: int = QUERY_BLOCK
) -> DataFrame:
    """The ``k`` documents of highest score above 0 for each row of ``items``: item, rank, document and score.

    Equal scores go by ascending document id, documents without one last. Null
    and empty texts have no term: such documents count for nothing and such
    items find nothing, as do items of which no document has a term. Repeated
    documents are ranked each, repeated items answered each. An empty table on
    either side gives an empty one. Other columns of both play no part. Both ids
    are integers. Items reach the driver ``query_block`` at a time; each block is
    one pass over the documents.
    """
    for df, name in ((docs, doc_id), (items, item_id)):
        if not isinstance(df.schema[name].dataType, IntegralType):
            raise TypeError(f"{name} must be an integer column")
    spark = docs.sparkSession
    kinds = items.schema[item_id].dataType.simpleString(), docs.schema[doc_id].dataType.simpleString()
    parts = []
    block: list[tuple] = []

    def answer() -> None:
        queries = Queries([i for i, _ in block], [dict(Counter(terms_of((t or "").encode()))) for _, t in block])
        block.clear()
        counted = materialize(count_terms(docs, list(queries.place), doc_id, text))
        n_docs, n_terms = counted.agg(F.sum((F.col("n") > 0).cast("long")), F.sum("n")).first()
        if not n_terms or not queries.place:
            return
        weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(n) + 1))) for n in document_frequencies(counted, len(queries.place))], np.int64)
        found = _search(counted, queries, weights, n_docs, n_terms, k, doc_id, kinds[0])
        order = (F.col("score").desc(), F.col("__doc").asc_nulls_last())
        group = F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS))
        first = Window.partitionBy("__query", "__group").orderBy(*order)
        last = Window.partitionBy("__query").orderBy(*order)
        some = found.withColumn("__group", group).withColumn("__at", F.row_number().over(first)).filter(F.col("__at") <= k)
        ranked = some.withColumn("rank", F.row_number().over(last)).filter(F.col("rank") <= k)
        parts.append(ranked.select(F.col("__item").alias(item_id), "rank", F.col("__doc").alias(doc_id), "score"))

    for row in items.select(item_id, text).toLocalIterator():
        block.append(tuple(row))
        if len(block) >= query_block:
            answer()
    if block:
        answer()
    if not parts:
        return spark.createDataFrame([], f"{item_id} {kinds[0]}, rank int, {doc_id} {kinds[1]}, score bigint")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
