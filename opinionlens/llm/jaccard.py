"""Exact set-similarity join of word n-grams with set-relation skipping.

A document's set is its distinct word n-grams; equal sets are one class. The
hashes of a set, sorted, are cut into blocks by their place in the hash space, so
many that two sets similar enough to link must agree on a whole non-empty block.
A class is entered in one index list for each of its blocks (key: size level,
block, and the block's content). That skips the rest of a list that single
n-grams would have: one that a passage puts into a third of all documents is met
only where nothing else stands beside it.

Each list is answered in three steps, and classes already in one component are
not compared again:

1. every member is compared with the list's first one, the pivot (or is in its
   component already, by the pivot of another list), first by size and parity
   sketch, then, if these leave a link possible, set by set;
2. members not linked with it are compared with the member of another component
   that a parity sketch shows as nearest;
3. what is left of other components is compared member by member, but only where
   the sizes, the sketches and the members' known distances from the pivot (which
   bound the distance of two members from below) still allow a link.

Components come from the links by alternating large-star and small-star steps.
Nothing is capped: all three bounds are exact. Sets are cut from the texts where
they are compared and are not stored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinionlens.llm.common import text_slices, with_fields
from opinionlens.llm.spans import document_key
from opinionlens.llm.texthash import U64, mix, run_hashes, words_of
from opinionlens.session import materialize

#: Rows of two long integers that are broadcast after a count; above it, joins shuffle.
MAX_BROADCAST_ROWS = 500_000
#: Members of one pivot that one task compares.
PIVOT_MEMBERS = 2_000
#: Members of one part of a long list; a task compares one part with itself or with another one.
LIST_MEMBERS = 2_000
GROWTH = 1.6


@dataclass(frozen=True)
class SetJoin:
    """Word n-grams and the least similarity, in per cent."""

    n: int = 4
    percent: int = 85
    #: A text with fewer words counts as one n-gram of all its words (else it has none).
    short_as_one: bool = True

    def __post_init__(self):
        if not 1 <= self.percent <= 100:
            raise ValueError("percent must be between 1 and 100")

    def max_difference(self, total: int) -> int:
        """Largest symmetric difference of two linked sets whose sizes add up to ``total``."""
        return (100 - self.percent) * total // (100 + self.percent)


def text_sets(texts: pa.Array, join: SetJoin) -> list[np.ndarray]:
    """Sorted distinct n-gram hashes of each text."""
    words = words_of(texts, lower=True)
    hashes, rows = run_hashes(words, join.n)
    counts = words.counts
    if join.short_as_one:
        for row in np.flatnonzero((counts > 0) & (counts < join.n)):
            own = words.hashes[words.rows == row]
            hashes = np.append(hashes, U64(xxhash.xxh3_64_intdigest(own.tobytes(), len(own))))
            rows = np.append(rows, row)
    order = np.lexsort((hashes, rows))
    hashes, rows = hashes[order], rows[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])
    hashes, rows = hashes[new], rows[new]
    return np.split(hashes, np.searchsorted(rows, np.arange(1, len(texts)))) if len(texts) else []


def class_of(own: np.ndarray) -> int:
    """Number of a set's class; 0 for the empty set."""
    return (xxhash.xxh3_64_intdigest(own.tobytes(), len(own)) or 1) - (1 << 63) if len(own) else 0


def levels(n: int, join: SetJoin) -> list[tuple[int, int]]:
    """(number, largest size) of each size level in which a set of ``n`` can meet one that it links with."""
    number, bound = 0, 8
    while n > bound:
        number, bound = number + 1, int(bound * GROWTH) + 1
    found = [(number, bound)]
    while 100 * n > join.percent * bound:
        number, bound = number + 1, int(bound * GROWTH) + 1
        found.append((number, bound))
    return found


def signatures(own: np.ndarray, join: SetJoin) -> np.ndarray:
    """Keys of the index lists of a set.

    In a level with sizes up to ``bound``, linked sets differ in at most ``d``
    n-grams, so of ``d + 1 + spare`` blocks at least ``1 + spare`` are equal, and
    one of these has n-grams unless more than ``spare`` blocks of both sets are
    empty. Sets with so many empty blocks also enter the lists of their first
    n-grams, of which two linked sets share one (prefix filter).
    """
    keys = []
    for number, bound in levels(len(own), join):
        d = join.max_difference(2 * bound)
        spare = -(-d // 20) + 1
        n_blocks = d + 1 + spare
        block = ((own >> U64(32)) * U64(n_blocks)) >> U64(32)
        first = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
        content = np.add.reduceat(mix(own + U64(number)), first)
        keys.append(mix(content ^ mix(block[first] + U64(number << 32))))
        if n_blocks - len(first) > spare:
            prefix = len(own) - -(-join.percent * len(own) // 100) + 1
            keys.append(mix(own[:prefix] ^ U64(0xA0761D6478BD642F + number)))
    return np.concatenate(keys)


def sketch(own: np.ndarray) -> bytes:
    """Parity of the number of n-grams in each of 256 or more buckets.

    Two sketches differ in at most as many bits as their sets in n-grams.
    """
    bits = max(256, 1 << int(len(own) - 1).bit_length())
    parity = np.bincount((mix(own) & U64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(parity.astype(np.uint8)).tobytes()


def folded(sketches: list[bytes]) -> np.ndarray:
    """Sketches as rows of 64-bit words, all of the shortest one's length."""
    size = min(map(len, sketches))
    rows = []
    for s in sketches:
        bits = np.frombuffer(s, np.uint8)
        while len(bits) > size:  # buckets are the low bits of a hash: halves fold onto each other
            bits = bits[: len(bits) // 2] ^ bits[len(bits) // 2 :]
        rows.append(bits)
    return np.stack(rows).view(U64)


def _few(rows: DataFrame) -> DataFrame:
    """A broadcast of narrow rows if their count allows it; else joins shuffle."""
    return F.broadcast(rows) if rows.count() <= MAX_BROADCAST_ROWS else rows


def memberships(docs: DataFrame, join: SetJoin, text: str = "text") -> DataFrame:
    """The other columns of ``docs``, ``n`` (set size) and ``cls`` (class of the set; 0: empty)."""
    names = [c for c in docs.columns if c != text]
    schema = with_fields(docs.select(*names).schema, n="bigint", cls="bigint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch, texts in text_slices(whole, text):
                sets = text_sets(texts, join)
                new = [pa.array([len(s) for s in sets], pa.int64()), pa.array([class_of(s) for s in sets], pa.int64())]
                yield pa.RecordBatch.from_arrays([*(batch[c] for c in names), *new], names=[*names, "n", "cls"])

    return docs.mapInArrow(run, schema)


def postings(docs: DataFrame, join: SetJoin, text: str = "text") -> DataFrame:
    """(sig, cls): the index lists that each class enters; a task enters a class once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for whole in batches:
            for _, texts in text_slices(whole, text):
                keys, owners = [np.zeros(0, U64)], [np.zeros(0, np.int64)]
                for own in text_sets(texts, join):
                    cls = class_of(own)
                    if cls and cls not in seen:
                        seen.add(cls)
                        keys.append(signatures(own, join))
                        owners.append(np.full(len(keys[-1]), cls))
                new = [np.concatenate(keys).view(np.int64), np.concatenate(owners)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in new], names=["sig", "cls"])

    return docs.select(text).mapInArrow(run, "sig bigint, cls bigint")


def index_lists(entries: DataFrame) -> DataFrame:
    """(sig, pivot, cls) of the lists with two classes or more; the pivot is a list's first class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[int, int, int, bool] | None = None  # sig, pivot, class of the last row, and if it was given out
        for batch in batches:
            sig, cls = batch["sig"].to_numpy(), batch["cls"].to_numpy()
            if not len(sig):
                continue
            if last:
                sig, cls = np.append(last[0], sig), np.append(last[2], cls)
            new = np.ones(len(sig), bool)
            new[1:] = (sig[1:] != sig[:-1]) | (cls[1:] != cls[:-1])
            own = np.flatnonzero(new)
            sig, cls = sig[own], cls[own]
            begins = np.ones(len(sig), bool)
            begins[1:] = sig[1:] != sig[:-1]
            start = np.maximum.accumulate(np.where(begins, np.arange(len(sig)), 0))
            pivot = cls[start]
            if last and last[3]:  # the first list began in an earlier batch
                pivot[start == 0] = last[1]
            many = np.ones(len(sig), bool)
            many[:-1] = ~(begins[:-1] & begins[1:])
            many[-1] = not begins[-1]
            if last and last[3]:
                many[start == 0] = True
                many[0] = False  # given out before
            yield pa.RecordBatch.from_arrays([pa.array(x[many]) for x in (sig, pivot, cls)], names=["sig", "pivot", "cls"])
            given = bool(many[-1]) or bool(last and last[3] and len(sig) == 1)
            last = int(sig[-1]), int(pivot[-1]), int(cls[-1]), given

    sorted_ = entries.repartition("sig").sortWithinPartitions("sig", "cls")
    return sorted_.mapInArrow(run, "sig bigint, pivot bigint, cls bigint")


def class_sketches(docs: DataFrame, wanted: DataFrame, join: SetJoin, key: str, text: str = "text") -> DataFrame:
    """(cls, n, sketch) of the documents with a key in ``wanted``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for _, texts in text_slices(whole, text):
                sets = text_sets(texts, join)
                columns = [
                    pa.array([class_of(s) for s in sets], pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([sketch(s) for s in sets], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["cls", "n", "sketch"])

    return docs.join(_few(wanted), key, "left_semi").select(text).mapInArrow(run, "cls bigint, n bigint, sketch binary")


def class_items(docs: DataFrame, wanted: DataFrame, join: SetJoin, key: str, text: str = "text") -> DataFrame:
    """(cls, items) of the documents with a key in ``wanted``: eight bytes an n-gram, far more than a text takes when stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for _, texts in text_slices(whole, text):
                sets = text_sets(texts, join)
                columns = [pa.array([class_of(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["cls", "items"])

    return docs.join(_few(wanted), key, "left_semi").select(text).mapInArrow(run, "cls bigint, items binary")


@dataclass(frozen=True)
class Sets:
    """Where the sets of listed classes are found: (cls, n, sketch), (cls, key) of a document of each, and the documents."""

    sketches: DataFrame
    owners: DataFrame
    docs: DataFrame
    join: SetJoin
    key: str
    text: str

    def items(self, classes: DataFrame) -> DataFrame:
        """(cls, items) of ``classes``, cut from their documents' texts anew; nothing is stored."""
        keys = materialize(self.owners.join(_few(classes), "cls", "left_semi").select(self.key))
        return class_items(self.docs, keys, self.join, self.key, self.text)


def _routes(pairs: DataFrame) -> DataFrame:
    """(cls, a, part): the places where each class of the pairs meets others.

    A class travels to the pairs' first classes it is compared with. A first
    class with many partners is spread over several tasks.
    """
    spread = pairs.groupBy("a").agg(F.ceil(F.count("*") / PIVOT_MEMBERS).cast("int").alias("parts"))
    members = pairs.join(spread, "a").select(F.col("b").alias("cls"), "a", F.pmod(F.xxhash64("b"), "parts").cast("int").alias("part"))
    owners = spread.select(F.col("a").alias("cls"), "a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    return materialize(members.unionByName(owners))


def _met(rows: DataFrame, routes: DataFrame) -> DataFrame:
    """The rows of each class at all its places, in a place that of the first class before all others."""
    placed = rows.join(_few(routes), "cls").withColumn("later", F.col("a") != F.col("cls"))
    return placed.repartition("a", "part").sortWithinPartitions("a", "part", "later").drop("later")


def near_pairs(pairs: DataFrame, sketches: DataFrame, join: SetJoin) -> DataFrame:
    """The distinct pairs (a, b) whose sizes and sketches allow a link. Both bounds are exact; no set travels."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, size, own = None, 0, b""
        for batch in batches:
            out: list[tuple[int, int]] = []
            for a, part, cls, n, bits in zip(*(batch[c].to_pylist() for c in ("a", "part", "cls", "n", "sketch")), strict=True):
                if a == cls:
                    key, size, own = (a, part), n, bits
                    continue
                if key != (a, part):
                    raise RuntimeError("a pair's first set is missing")
                if 100 * min(n, size) < join.percent * max(n, size):
                    continue
                mine, other = folded([own, bits])
                if int(np.bitwise_count(mine ^ other).sum(dtype=np.int64)) <= join.max_difference(n + size):
                    out.append((a, cls))
            columns = [pa.array([row[i] for row in out], pa.int64()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, names=["a", "b"])

    ready = _met(sketches, _routes(pairs)).select("a", "part", "cls", "n", "sketch")
    return ready.mapInArrow(run, "a bigint, b bigint").distinct()


def compare(pairs: DataFrame, sets: Sets) -> DataFrame:
    """(a, b, difference, linked), exactly, of those distinct pairs (a, b) that sizes and sketches leave; the others do not link.

    Sets are made and sent for these pairs alone: most pairs of a list share a
    passage and no more.
    """
    join = sets.join
    routes = _routes(materialize(near_pairs(pairs, sets.sketches, join)))
    ready = _met(sets.items(routes.select("cls").distinct()), routes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, own = None, np.zeros(0, U64)
        for batch in batches:
            out: list[tuple[int, int, int, bool]] = []
            for a, part, cls, items in zip(*(batch[c].to_pylist() for c in ("a", "part", "cls", "items")), strict=True):
                other = np.frombuffer(items, U64)
                if a == cls:
                    key, own = (a, part), other
                    continue
                if key != (a, part):
                    raise RuntimeError("a pair's first set is missing")
                at = np.searchsorted(own, other)
                same = int(np.count_nonzero(own[np.minimum(at, len(own) - 1)] == other))
                total = len(own) + len(other)
                out.append((a, cls, total - 2 * same, 100 * same >= join.percent * (total - same)))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_())
            columns = [pa.array([row[i] for row in out], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "difference", "linked"])

    found = ready.select("a", "part", "cls", "items").mapInArrow(run, "a bigint, b bigint, difference bigint, linked boolean")
    return found.distinct()


def components(edges: DataFrame) -> DataFrame:
    """(cls, root) of every class that an edge (a, b) names; the root is the smallest class reached."""
    spark = edges.sparkSession
    now = materialize(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct())
    before = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialize(large)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        own = large.join(least, "u")
        small = own.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        now = materialize(small.filter("u <> v").distinct())
    roots = now.select(F.col("u").alias("cls"), F.col("v").alias("root"))
    return roots.union(roots.select(F.col("root").alias("cls"), "root").distinct()) if not now.isEmpty() else spark.createDataFrame([], "cls bigint, root bigint")


def open_pairs(lists: DataFrame, roots: DataFrame, answers: DataFrame, sketches: DataFrame, join: SetJoin, nearest: bool) -> DataFrame:
    """Distinct pairs (a, b) of lists whose members are in several components and may still link.

    ``nearest``: for each member only the one that its sketch is nearest to.
    ``answers`` has distances of members from the pivots, where these were needed.
    """
    rooted = lists.join(_few(roots), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    torn = materialize(rooted.groupBy("sig").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi").select("sig"))
    known = answers.select(F.col("a").alias("pivot"), F.col("b").alias("cls"), "difference")
    left = materialize(rooted.join(_few(torn), "sig"))
    rows = left.join(known, ["pivot", "cls"], "left").join(sketches.dropDuplicates(["cls"]), "cls")
    # A long list is cut into parts; a member meets each part, its own included, in a task of its own.
    long = left.groupBy("sig").agg(F.ceil(F.count("*") / LIST_MEMBERS).cast("int").alias("parts")).filter("parts > 1")
    rows = rows.join(_few(materialize(long)), "sig", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("cls"), "parts").cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    ready = rows.select(
        "sig",
        F.least("part", "other").alias("i"),
        F.greatest("part", "other").alias("j"),
        "part", "cls", "root", "n",
        # Distance from the pivot; -1 where they were not compared.
        F.when(F.col("cls") == F.col("pivot"), F.lit(0)).otherwise(F.coalesce("difference", F.lit(-1))).cast("long").alias("d"),
        "sketch",
    )
    ready = ready.repartition("sig", "i", "j").sortWithinPartitions("sig", "i", "j", "n", "cls")

    def answer(part: np.ndarray, both: bool, cls: np.ndarray, root: np.ndarray, n: np.ndarray, d: np.ndarray, sketches: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        words = folded(sketches)
        left_, right = [], []
        best = np.full(len(cls), np.iinfo(np.int64).max)
        partner = np.full(len(cls), -1)
        for i in range(len(cls) - 1):
            end = np.searchsorted(n, 100 * n[i] // join.percent, side="right")  # larger ones cannot link
            other = np.arange(i + 1, end)
            other = other[part[other] != part[i]] if both else other  # those of one part meet in its own task
            limit = (100 - join.percent) * (n[i] + n[other]) // (100 + join.percent)
            near = (d[other] < 0) | (d[i] < 0) | (np.abs(d[other] - d[i]) <= limit)
            other, limit = (x[(root[other] != root[i]) & near] for x in (other, limit))
            apart = np.bitwise_count(words[other] ^ words[i]).sum(axis=1, dtype=np.int64)
            other, apart = other[apart <= limit], apart[apart <= limit]
            if not len(other):
                continue
            if not nearest:
                left_.append(np.full(len(other), i))
                right.append(other)
                continue
            j = np.argmin(apart)
            if apart[j] < best[i]:
                best[i], partner[i] = apart[j], other[j]
            closer = other[apart < best[other]]
            best[closer], partner[closer] = apart[apart < best[other]], i
        if nearest:
            found = np.flatnonzero(partner >= 0)
            return cls[found], cls[partner[found]]
        x = np.concatenate(left_) if left_ else np.zeros(0, np.int64)
        y = np.concatenate(right) if right else np.zeros(0, np.int64)
        return cls[x], cls[y]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in _with_end(batches):
            if batch is not None:
                table = pa.Table.from_batches([batch])
                held = table if held is None else pa.concat_tables([held, table])
            if held is None or not held.num_rows:
                continue
            keys = [held[c].to_numpy() for c in ("sig", "i", "j")]
            new = np.any([k[1:] != k[:-1] for k in keys], axis=0)
            bounds = np.append(np.flatnonzero(np.append(True, new)), len(keys[0]))
            whole = len(bounds) - 1 - (batch is not None)  # the last list may go on
            found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
            for i in range(whole):
                own = held.slice(bounds[i], bounds[i + 1] - bounds[i])
                columns = [own[c].to_numpy() for c in ("cls", "root", "n", "d")]
                both = bool(keys[1][bounds[i]] != keys[2][bounds[i]])
                found.append(answer(own["part"].to_numpy(), both, *columns, own["sketch"].to_pylist()))
            a, b = (np.concatenate([f[k] for f in found]) for k in (0, 1))
            pair = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(pair[:, 0]), pa.array(pair[:, 1])], names=["a", "b"])
            held = held.slice(bounds[whole])

    fresh = ready.mapInArrow(run, "a bigint, b bigint").distinct()
    return materialize(fresh.join(answers.select("a", "b"), ["a", "b"], "left_anti"))


def _with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def similar_classes(docs: DataFrame, member: DataFrame, join: SetJoin, text: str, key: str) -> DataFrame:
    """(cls, root) of the classes linked with another one."""
    lists = materialize(index_lists(postings(docs, join, text)))
    listed = lists.select("cls").distinct()
    reps = member.filter("cls <> 0").groupBy("cls").agg(F.min(key).alias(key))
    owners = materialize(reps.join(listed, "cls").select("cls", key))
    texts = docs.select(key, text)
    sets = Sets(materialize(class_sketches(texts, owners.select(key), join, key, text)), owners, texts, join, key, text)
    star = materialize(lists.filter("cls <> pivot").select(F.least("pivot", "cls").alias("a"), F.greatest("pivot", "cls").alias("b")).distinct())
    # A class is first compared with one pivot; with its others only where that has not joined them.
    first = materialize(star.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"))
    answers = materialize(compare(first, sets))
    roots = _few(materialize(components(answers.filter("linked"))))
    rest = star.join(first, ["a", "b"], "left_anti")
    for side in ("a", "b"):
        rest = rest.join(roots.select(F.col("cls").alias(side), F.col("root").alias(f"root_{side}")), side, "left")
    rest = materialize(rest.filter(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select("a", "b"))
    if not rest.isEmpty():
        answers = materialize(answers.unionByName(compare(rest, sets)))
    for nearest in (True, False):
        roots = materialize(components(answers.filter("linked")))
        more = open_pairs(lists, roots, answers, sets.sketches, join, nearest)
        if not more.isEmpty():
            answers = materialize(answers.unionByName(compare(more, sets)))
    return components(answers.filter("linked"))


def _rooted(docs: DataFrame, join: SetJoin, doc_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(__id, __key, n, cls) of every distinct document, and (cls, root) of every class."""
    keyed = docs.select(F.col(doc_id).alias("__id"), document_key(doc_id, text).alias("__key"), F.col(text).alias("__text"))
    member = materialize(memberships(keyed, join, "__text").distinct())
    linked = similar_classes(keyed, member, join, "__text", "__key")
    classes = member.filter("cls <> 0").select("cls").distinct().join(linked, "cls", "left")
    return member, materialize(classes.select("cls", F.coalesce("root", "cls").alias("root")))


def jaccard_components(docs: DataFrame, join: SetJoin | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of ``docs``: its other columns but the text, ``n_shingles`` and ``component_id``.

    ``component_id`` is the smallest ``doc_id`` reachable by links, itself
    included (null if none of them has an id). Null and empty texts and those
    without words have the empty set, which links with nothing. Rows with equal
    sets are linked, repeated rows among them. An empty table gives an empty
    one. Columns of ``docs`` named like an added one are replaced; names with
    two leading underscores are the operator's own.
    """
    join = join or SetJoin()
    member, roots = _rooted(docs, join, doc_id, text)
    rooted = member.filter("cls <> 0").groupBy("cls").agg(F.min("__id").alias("__least")).join(roots, "cls")
    least = rooted.groupBy("root").agg(F.min("__least").alias("component_id"))
    by_class = rooted.join(least, "root").select("cls", "component_id")
    own = member.join(by_class, "cls", "left").select(
        "__key", F.col("n").alias("__n"), F.when(F.col("cls") == 0, F.col("__id")).otherwise(F.col("component_id")).alias("__component")
    )
    names = [c for c in docs.columns if c not in ("n_shingles", "component_id")]
    rows = docs.withColumn("__key", document_key(doc_id, text)).drop(*[c for c in docs.columns if c not in names and c != text])
    kept = rows.select(*[c for c in names if c != text], "__key").join(own, "__key", "left")
    return kept.withColumnsRenamed({"__n": "n_shingles", "__component": "component_id"}).drop("__key")


def keep_one_of_each(docs: DataFrame, join: SetJoin | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component the smallest ``doc_id`` stays.

    Documents without an id come last. Rows equal in id and text are one
    document, of which one row stays; documents without words all stay.
    """
    member, roots = _rooted(docs, join or SetJoin(), doc_id, text)
    place = F.struct(F.col("__id").isNull().alias("no_id"), F.col("__id").alias("id"), F.col("__key").alias("key"))
    least = member.join(roots, "cls").groupBy("root").agg(F.min(place).alias("least")).select("root", F.col("least.key").alias("least"))
    gone = materialize(member.join(roots, "cls").join(least, "root").filter("__key <> least").select("__key"))
    keyed = docs.withColumn("__key", document_key(doc_id, text))
    kept = keyed.join(_few(gone), "__key", "left_anti")
    repeated = keyed.select("__key").groupBy("__key").agg(F.count("*").alias("n")).filter("n > 1")
    if not repeated.isEmpty():
        kept = kept.dropDuplicates(["__key"])
    return kept.drop("__key")
