"""Substring dedup by sliding sentence spans.

A sentence ends at a full stop, question or exclamation mark before white space,
or at a line end. More than ``QUIET`` words away from such ends it is cut where
the words themselves say so: after the word of the smallest hash of any ``WINDOW``
words in a row. So text without marks has sentences of at most ``MAX_SENTENCE``
words too, and texts that share a passage are cut alike from ``QUIET`` words inside
it on, wherever it stands. The shortest run of at least ``MIN_SENTENCES`` sentences and
``MIN_WORDS`` words from each sentence on is hashed, and so is the shortest one up
to it: together they cover every longer run of the same sentences. Spans of equal
hashes (96 bits) are joined over all documents, and the sentences that any but the
first of them covers are removed. The first is that of the smallest doc_id, then of
the smallest place in the text.

A task keeps the first span of each hash among its own and already knows the
others as repeated, so a hash that a third of all documents have comes to its join
once for each flush of a task. The firsts travel in packed columns, one row for
each part of the hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from opinionlens.llm.common import drop_held, release, text_slices, with_fields
from opinionlens.llm.texthash import U64, _powers, mix, words_of

MIN_SENTENCES = 2
MIN_WORDS = 20
MAX_SENTENCE = 30  # 2 * QUIET + WINDOW at most
QUIET = 8
WINDOW = 6
#: Spans that a task compares among themselves before it gives out the firsts.
FLUSH_SPANS = 1_000_000
#: Set in ``size`` for a span of a document without an id, which comes after all others.
NO_ID = np.int32(1 << 30)
PACKED = "part bigint, repeated boolean, hash binary, check binary, id binary, key binary, at binary, size binary"
KINDS = {"hash": U64, "check": np.uint32, "id": np.int64, "key": np.int64, "at": np.int32, "size": np.int32}


def least_of_windows(values: np.ndarray, groups: np.ndarray, window: int) -> np.ndarray:
    """Mark each value that is the least of some ``window`` values in a row of one group, equal ones all."""
    least = np.zeros(len(values), bool)
    n = len(values) - window + 1
    if n <= 0:
        return least
    low = np.minimum.reduce([values[j : j + n] for j in range(window)])
    inside = groups[:n] == groups[window - 1 :]
    for j in range(window):
        least[j : j + n] |= inside & (values[j : j + n] == low)
    return least


class Sentences:
    """Sentences of several texts: first word, number of the text, and byte span."""

    def __init__(self, texts: pa.Array):
        self.words = w = words_of(texts, lower=False)
        n = len(w.hashes)
        begins = np.ones(n + 1, bool)
        if n:
            lines = np.concatenate([[0], np.cumsum(w.data == 10)])
            stop = np.isin(w.data[w.ends[:-1] - 1], np.frombuffer(b".!?", np.uint8))
            begins[1:n] = stop | (lines[w.starts[1:]] > lines[w.ends[:-1]]) | (w.rows[1:] != w.rows[:-1])
            ends = np.flatnonzero(begins)
            at = np.arange(1, n)  # a cut before this word
            behind = np.searchsorted(ends, at, side="right")
            quiet = (at - ends[behind - 1] > QUIET) & (ends[behind] - at > QUIET)
            begins[1:n] |= quiet & least_of_windows(w.hashes, w.rows, WINDOW)[:-1]
        begins = begins[:n]
        self.first = np.append(np.flatnonzero(begins), n)
        self.rows = w.rows[self.first[:-1]]
        self.of_row = np.searchsorted(self.rows, np.arange(w.n_rows + 1))

    def spans(self, min_sentences: int, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sentence that begins each span, number of its sentences, and two hashes of its words; a span comes once."""
        n = len(self.first) - 1
        begin = np.arange(n)
        end = np.searchsorted(self.first, self.first[:-1] + min_words)  # first word behind, as a sentence number
        end = np.maximum(end, begin + min_sentences)
        until = np.arange(1, n + 1)
        since = np.searchsorted(self.first, self.first[1:] - min_words, side="right") - 1
        since = np.minimum(since, until - min_sentences)
        whole = end <= self.of_row[self.rows + 1] if n else np.zeros(0, bool)
        tail = since >= self.of_row[self.rows] if n else np.zeros(0, bool)
        tail[tail] = end[since[tail]] != until[tail]  # not one of the others
        begin, end = np.append(begin[whole], since[tail]), np.append(end[whole], until[tail])
        a, b = self.first[begin], self.first[end]
        up, down = _powers(len(self.words.hashes) + 1)
        found = []
        for codes in (self.words.hashes, mix(self.words.hashes ^ U64(0xA0761D6478BD642F))):
            sums = np.zeros(len(codes) + 1, U64)
            np.cumsum(codes * up[: len(codes)], dtype=U64, out=sums[1:])
            found.append(mix((sums[b] - sums[a]) * down[a] + (b - a).astype(U64)))
        return begin, end - begin, found[0], found[1].astype(np.uint32)


def document_key(doc_id: str, text: str) -> Column:
    """Key of a document by its id and text, defined for nulls; rows equal in both are one document."""
    return F.xxhash64(F.col(doc_id).isNull(), F.col(doc_id), F.col(text).isNull(), F.col(text))


def later_spans(columns: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Places of the first span of each hash, and of the others (not those of the first's own document and place)."""
    empty = np.zeros(0, np.int64)
    if not len(columns["hash"]):
        return empty, empty
    no_id = columns["size"] >= NO_ID
    order = np.lexsort((columns["at"], columns["key"], columns["id"], no_id, columns["check"], columns["hash"]))
    new = np.ones(len(order), bool)
    new[1:] = False
    for name in ("hash", "check"):
        own = columns[name][order]
        new[1:] |= own[1:] != own[:-1]
    first = order[new][np.cumsum(new) - 1]
    same = np.ones(len(order), bool)
    for name in ("id", "key", "at"):
        same &= columns[name][order] == columns[name][first]
    same &= no_id[order] == no_id[first]
    return order[new], order[~same]


def packed_spans(docs: DataFrame, parts: int, min_sentences: int, min_words: int) -> DataFrame:
    """Spans of (__id, __key, __text) in packed columns: the firsts of each task by part of the hash, and its repeated ones."""

    def rows_of(columns: dict[str, np.ndarray], part: np.ndarray, repeated: bool) -> list[list]:
        order = np.argsort(part, kind="stable")
        own, begin = np.unique(part[order], return_index=True)
        ends = np.append(begin, len(order))[1:]
        return [[int(p), repeated, *(c[order[a:b]].tobytes() for c in columns.values())] for p, a, b in zip(own, begin, ends, strict=True)]

    def give(held: list[dict[str, np.ndarray]]) -> pa.RecordBatch:
        columns = {name: np.concatenate([h[name] for h in held]) for name in KINDS}
        first, later = later_spans(columns)
        mine, others = ({name: c[at] for name, c in columns.items()} for at in (first, later))
        rows = rows_of(mine, ((mine["hash"] >> U64(20)) % U64(parts)).astype(np.int64), False)
        rows += rows_of(others, ((mix(others["key"].view(U64)) >> U64(20)) % U64(parts)).astype(np.int64), True)
        kinds = (pa.int64(), pa.bool_(), *[pa.binary()] * len(KINDS))
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["part", "repeated", *KINDS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_held()
        held: list[dict[str, np.ndarray]] = []
        for whole in batches:
            for batch, texts in text_slices(whole, "__text"):
                found = Sentences(texts)
                begin, size, hashes, checks = found.spans(min_sentences, min_words)
                rows = found.rows[begin]
                ids = batch["__id"]
                no_id = np.asarray(ids.is_null())[rows]
                held.append(
                    {
                        "hash": hashes,
                        "check": checks,
                        "id": ids.fill_null(0).to_numpy()[rows],
                        "key": batch["__key"].to_numpy()[rows],
                        "at": (begin - found.of_row[rows]).astype(np.int32),
                        "size": (size + np.where(no_id, NO_ID, 0)).astype(np.int32),
                    }
                )
                if sum(len(h["hash"]) for h in held) >= FLUSH_SPANS:
                    yield give(held)
                    held = []
        if held:
            yield give(held)
        release()

    return docs.select("__text", "__id", "__key").mapInArrow(run, PACKED)


def repeated_spans(packed: DataFrame) -> DataFrame:
    """(__key, at, size) of every span that is not the first of its hash; a task holds one part at a time."""

    def rows_of(columns: dict[str, np.ndarray], at: np.ndarray) -> pa.RecordBatch:
        size = columns["size"][at] & ~NO_ID
        return pa.RecordBatch.from_arrays([pa.array(columns["key"][at]), pa.array(columns["at"][at]), pa.array(size)], names=["__key", "at", "size"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, held = None, []

        def answer() -> pa.RecordBatch:
            columns = {name: np.concatenate([h[name] for h in held]) for name in KINDS}
            return rows_of(columns, later_spans(columns)[1])

        for batch in batches:
            for i in range(batch.num_rows):
                part, repeated = batch["part"][i].as_py(), batch["repeated"][i].as_py()
                columns = {name: np.frombuffer(batch[name][i].as_buffer(), kind) for name, kind in KINDS.items()}
                if repeated:
                    yield rows_of(columns, np.arange(len(columns["at"])))
                    continue
                if own != part and held:
                    yield answer()
                    held = []
                own = part
                held.append({name: c.copy() for name, c in columns.items()})
        if held:
            yield answer()
        release()

    placed = packed.repartition("part").sortWithinPartitions("part")
    return placed.mapInArrow(run, "__key bigint, at int, size int")


def remove_sentences(docs: DataFrame, text: str = "text", spans: str = "__spans") -> DataFrame:
    """Cut the sentences of each row's spans (array of at and size; null: none) out of its text.

    Adds ``n_sentences`` and ``n_removed``.
    """
    names = [c for c in docs.columns if c not in (text, spans, "n_sentences", "n_removed")]
    schema = with_fields(docs.select(*names, text).schema, n_sentences="bigint", n_removed="bigint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch, texts in text_slices(whole, text):
                found = Sentences(texts)
                data = found.words.data
                starts = found.words.starts[found.first[:-1]] if len(data) else np.zeros(0, np.int64)
                bounds = np.append(starts, len(data))
                sizes = np.diff(found.of_row)
                kept = batch[text].to_pylist()
                removed = np.zeros(batch.num_rows, np.int64)
                ends = np.cumsum([len(t.as_buffer()) if t.is_valid else 0 for t in texts])
                for row, own in enumerate(batch[spans].to_pylist()):
                    if not own:
                        continue
                    gone = np.zeros(sizes[row] + 1, np.int64)
                    for span in own:
                        gone[span["at"]] += 1
                        gone[span["at"] + span["size"]] -= 1
                    gone = np.cumsum(gone)[:-1] > 0
                    first = found.of_row[row]
                    row_start = ends[row - 1] if row else 0
                    limits = np.minimum(bounds[first : first + sizes[row] + 1], ends[row])
                    parts = [data[row_start : limits[0]]]
                    parts += [data[limits[i] : limits[i + 1]] for i in np.flatnonzero(~gone)]
                    kept[row] = np.concatenate(parts).tobytes().decode()
                    removed[row] = gone.sum()
                columns = [*(batch[c] for c in names), pa.array(kept, batch[text].type), pa.array(sizes), pa.array(removed)]
                yield pa.RecordBatch.from_arrays(columns, names=[*names, text, "n_sentences", "n_removed"])

    return docs.select(*names, text, spans).mapInArrow(run, schema)


def dedup_spans(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_sentences: int = MIN_SENTENCES,
    min_words: int = MIN_WORDS,
) -> DataFrame:
    """Remove repeated sentence spans from all texts; every row stays, even if its text gets empty.

    Adds ``n_sentences`` and ``n_removed``. Null texts stay null and empty ones
    empty. Ids are integers; a document without one comes after all others. Rows equal in id and
    text count as one document and get the same text. An empty table gives an
    empty one. Columns of ``docs`` named like an added one are replaced; names
    with two leading underscores are the operator's own.
    """
    if not isinstance(docs.schema[doc_id].dataType, IntegralType):
        raise TypeError(f"{doc_id} must be an integer column")
    spark = docs.sparkSession
    keyed = docs.withColumn("__key", document_key(doc_id, text))
    narrow = keyed.select(F.col(doc_id).cast("long").alias("__id"), "__key", F.col(text).alias("__text"))
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    gone = repeated_spans(packed_spans(narrow, parts, min_sentences, min_words))
    cut = gone.groupBy("__key").agg(F.collect_set(F.struct("at", "size")).alias("__spans"))  # at most two for each sentence
    marked = keyed.join(cut, "__key", "left").drop("__key")
    return remove_sentences(marked, text).select(*docs.columns, "n_sentences", "n_removed")
