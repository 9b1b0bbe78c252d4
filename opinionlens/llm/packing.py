"""Packing of tokenized documents into windows by non-negative least squares.

Each document is cut into full windows and one rest. The lengths of all pieces
are counted in Spark; the histogram has at most ``window`` entries. On it, all
combinations of two or three lengths that fill a window exactly are enumerated,
their repeat counts are solved by non-negative least squares, rounded, and the
pieces left over are packed greedily, longest first with the longest that fits.
If more than ``slack`` of a window stays empty, another left-over piece is cut to
fill it. Pieces find their place by their rank among those of equal length, so no
task or driver holds more than the histogram and the list of placements.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinionlens.llm.common import with_fields, worker_held
from opinionlens.operators.scaling import with_position
from opinionlens.session import materialize

#: Words that a worker remembers the ids of; beyond it, it starts afresh.
MAX_WORDS = 600_000
#: Steps of the least-squares solver.
STEPS = 400

# Fixed value: the pattern by which the tokenizer's vocabulary was split into words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# A blank before a character that is no white space always begins a word.
_BLANK = re.compile(r" (?=[^\s]|[\x1c-\x1f])")


def byte_ranks(tokenizer: tokenizers.Tokenizer) -> dict[bytes, int]:
    """The vocabulary of a byte-level tokenizer, as bytes; special tokens are left out.

    Printable bytes stand for themselves in it, and the others, in order, for
    the characters from U+0100 on.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(plain)))}
    special = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    return {bytes(byte_of[c] for c in token): i for token, i in tokenizer.get_vocab().items() if token not in special}


class WordTokenizer:
    """Ids of texts by the vocabulary of a byte-level tokenizer file, found once for each word.

    Words go through tiktoken, which merges by rank as the tokenizers library
    does by its list of merges, at a fraction of its time; that the two agree on
    the file is checked at the start. Texts that hold a special token go through
    the tokenizers library.
    """

    def __init__(self, file: str):
        self.tokenizer = tokenizers.Tokenizer.from_file(file)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(file, encoding="utf-8") as f:
            merges = json.load(f)["model"]["merges"]
        vocabulary = self.tokenizer.get_vocab()
        ids = [vocabulary["".join(m if isinstance(m, list) else m.split(" "))] for m in merges]
        if ids != sorted(ids):
            raise ValueError("the tokenizer's ids are not in the order of its merges")
        self.words = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=byte_ranks(self.tokenizer), special_tokens={})
        for probe in ("It's 12 o'clock,  isn't it?\n\n \tÜber 日本 🙂 ", "don't\x1c  stop\u00a0now"):
            if self.words.encode_ordinary(probe) != self.tokenizer.encode(probe, add_special_tokens=False).ids:
                raise ValueError("the tokenizer splits texts in another way")
        self.chunks: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        if any(s in text for s in self.special):  # a special token cuts the text before words are split
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        first, *rest = _BLANK.split(text)
        out = list(map(self.chunks.get, rest))
        if None in out:
            for i, known in enumerate(out):
                if known is None:
                    out[i] = self.chunks.get(rest[i]) or self._spaced(rest[i])
        return array("I", self.words.encode_ordinary(first)).tobytes() + b"".join(out)

    def _spaced(self, word: str) -> bytes:
        """Ids of a word with the blank before it; the memory is keyed without the blank."""
        if len(self.chunks) >= MAX_WORDS:
            self.chunks.clear()
        known = self.chunks[word] = array("I", self.words.encode_ordinary(" " + word)).tobytes()
        return known


def cut_pieces(docs: DataFrame, tokenizer_file: str, window: int, text: str = "text", end_id: int = 0) -> DataFrame:
    """Tokenize every whole text and cut it into full windows and one rest.

    One row per piece: the other columns of ``docs``, then start, length,
    ids_crc32, doc_tokens, and the ids of a rest as bytes (a full window has
    none, as it is never cut again).
    """
    added = ("start", "length", "ids_crc32", "doc_tokens", "ids")
    names = [c for c in docs.columns if c not in added and c != text]
    kept = docs.select(F.col(text).alias("__text"), *names)
    schema = with_fields(docs.select(*names).schema, **dict.fromkeys(added[:-1], "bigint"), ids="binary")
    end = np.asarray([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = worker_held(("tokenizer", tokenizer_file), lambda: WordTokenizer(tokenizer_file))
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                rows, starts, lengths, crcs, totals, ids = [], [], [], [], [], []
                for row, found in enumerate(map(own.encode, pc.fill_null(batch["__text"], "").to_pylist())):
                    data = found + end
                    n = len(data) // 4
                    for start in range(0, n, window):
                        piece = data[4 * start : 4 * (start + window)]
                        rows.append(row)
                        starts.append(start)
                        lengths.append(len(piece) // 4)
                        crcs.append(zlib.crc32(piece))
                        totals.append(n)
                        ids.append(piece if len(piece) < 4 * window else None)
                other = batch.select(names).take(pa.array(rows, pa.int64()))
                new = [*(pa.array(x, pa.int64()) for x in (starts, lengths, crcs, totals)), pa.array(ids, pa.binary())]
                yield pa.RecordBatch.from_arrays([*other.columns, *new], names=[*names, *added])

    return kept.mapInArrow(run, schema)


@dataclass
class Placement:
    """Pieces of one length, of ranks ``first`` to ``first + count``, of which each gives
    ids ``cut`` to ``cut + length``: one to each sequence from ``sequence`` on, at ``offset``."""

    bin: int
    first: int
    count: int
    cut: int
    length: int
    sequence: int = 0
    offset: int = 0


def filling_combinations(lengths: np.ndarray, window: int) -> np.ndarray:
    """Rows of three lengths, rising, that sum to ``window``; pairs have a 0 before them."""
    present = np.zeros(window + 1, bool)
    present[lengths] = True
    found = []
    for a in [0, *sorted(int(x) for x in lengths if 3 * x <= window)]:
        b = np.arange(max(a, 1), (window - a) // 2 + 1)
        b = b[present[b] & present[window - a - b]]
        found.append(np.stack([np.full(len(b), a), b, window - a - b], axis=1))
    return np.concatenate(found)


def repeat_counts(combinations: np.ndarray, histogram: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Non-negative least squares of the histogram by combinations, by accelerated projected gradient."""
    if not len(combinations):
        return np.zeros(0)
    target = histogram.astype(float)
    target[0] = 0
    scale = max(target.max(), 1.0)
    target = target / scale
    flat = combinations.ravel()

    def counts(x: np.ndarray) -> np.ndarray:
        out = np.bincount(flat, np.repeat(x, 3), len(target))
        out[0] = 0
        return out

    probe = np.ones(len(combinations))
    for _ in range(20):  # largest eigenvalue of A'A
        probe = counts(probe)[combinations].sum(axis=1)
        norm = np.linalg.norm(probe)
        probe = probe / norm
    x = y = np.zeros(len(combinations))
    momentum = 1.0
    for _ in range(steps):
        slope = (counts(y) - target)[combinations].sum(axis=1)
        new = np.maximum(y - slope / (1.05 * norm), 0)
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        y = new + (momentum - 1) / following * (new - x)
        x, momentum = new, following
    return x * scale


def plan_packing(histogram: np.ndarray, window: int, slack: int) -> list[Placement]:
    """Where the pieces of each length go; ``histogram[n]`` pieces have length ``n``."""
    left = histogram.astype(np.int64).copy()
    used = np.zeros_like(left)
    plan: list[Placement] = []
    sequence = 0

    def place(lengths: list[int], count: int) -> None:
        nonlocal sequence
        offset = 0
        for n in lengths:
            plan.append(Placement(n, int(used[n]), count, 0, n, sequence, offset))
            used[n] += count
            left[n] -= count
            offset += n
        sequence += count

    if left[window]:
        place([window], int(left[window]))
    combinations = filling_combinations(np.flatnonzero(left), window)
    counts = np.rint(repeat_counts(combinations, left)).astype(np.int64)
    for i in np.argsort(-counts, kind="stable"):
        if counts[i] == 0:
            break
        lengths = [int(n) for n in combinations[i] if n]
        fits = min(int(left[n]) // lengths.count(n) for n in lengths)
        if fits:
            place(lengths, min(int(counts[i]), fits))
    rest = [Placement(int(n), int(used[n]), int(left[n]), 0, int(n)) for n in np.flatnonzero(left)]
    return plan + pack_rest(rest, window, slack, sequence)


def pack_rest(groups: list[Placement], window: int, slack: int, sequence: int) -> list[Placement]:
    """Greedy packing of what is left, a whole group of equal pieces at a time."""
    pool: dict[int, list[Placement]] = {}
    lengths: list[int] = []

    def put(group: Placement) -> None:
        if group.length not in pool:
            pool[group.length] = []
            insort(lengths, group.length)
        pool[group.length].append(group)

    for group in groups:
        put(group)
    plan = []
    while lengths:
        chosen: list[Placement] = []
        taken: dict[int, int] = {}  # times that a group is in the pattern, by identity
        room = window

        def pick(i: int) -> Placement | None:
            """The longest piece of at most the i-th length that the pattern has not used up."""
            for n in reversed(lengths[:i]):
                for group in reversed(pool[n]):
                    if taken.get(id(group), 0) < group.count:
                        return group
            return None

        while room and (group := pick(bisect_right(lengths, room))):
            chosen.append(group)
            taken[id(group)] = taken.get(id(group), 0) + 1
            room -= group.length
        cut = None
        if room > slack:
            for n in lengths[bisect_left(lengths, room + 1) :]:
                cut = next((g for g in pool[n] if taken.get(id(g), 0) < g.count), None)
                if cut:
                    taken[id(cut)] = taken.get(id(cut), 0) + 1
                    break
        held = {id(g): g for g in [*chosen, *([cut] if cut else [])]}
        count = min(g.count // taken[i] for i, g in held.items())
        offset = 0
        for group in [*chosen, *([cut] if cut else [])]:
            n = min(group.length, window - offset)
            plan.append(Placement(group.bin, group.first, count, group.cut, n, sequence, offset))
            if n < group.length:
                put(Placement(group.bin, group.first, count, group.cut + n, group.length - n))
            group.first += count
            group.count -= count
            offset += n
        for group in held.values():
            if not group.count:
                pool[group.length].remove(group)
                if not pool[group.length]:
                    del pool[group.length]
                    lengths.remove(group.length)
        sequence += count
    return plan


def pack(
    docs: DataFrame,
    tokenizer_file: str,
    window: int = 1024,
    slack: int = 16,
    text: str = "text",
    end_id: int = 0,
) -> DataFrame:
    """Pack all documents into sequences of at most ``window`` ids.

    One row per piece: the other columns of ``docs``, start, length, ids_crc32,
    doc_tokens, sequence_id, offset, and ids (bytes of little-endian unsigned
    32-bit integers; null for a piece that fills a window alone). Null and empty
    texts have the end id alone. Each repeated row is packed. An empty table
    gives an empty one. Columns of ``docs`` named like an added one are replaced;
    names with two leading underscores are the operator's own.
    """
    pieces = cut_pieces(docs, tokenizer_file, window, text, end_id)
    pieces = materialize(pieces.withColumn("__salt", F.xxhash64("ids_crc32", "doc_tokens", F.monotonically_increasing_id())))
    histogram = np.zeros(window + 1, np.int64)
    for row in pieces.groupBy("length").agg(F.count("*").alias("n")).collect():  # at most ``window`` rows
        histogram[row["length"]] = row["n"]
    below = np.concatenate([[0], np.cumsum(histogram)[:-1]])
    plan = plan_packing(histogram, window, slack)
    table = {f: np.asarray([getattr(p, f) for p in plan], np.int64) for f in Placement.__dataclass_fields__}
    order = np.lexsort((table["first"], table["bin"]))
    table = {f: x[order] for f, x in table.items()}
    edges = np.searchsorted(table["bin"], np.arange(window + 2))
    shared = docs.sparkSession.sparkContext.broadcast((table, edges, below))

    placed = with_position(pieces, ["length", "__salt"], "__position").drop("__salt")
    names = [c for c in placed.columns if c not in ("__position", "sequence_id", "offset", "ids")]
    schema = with_fields(placed.select(*names).schema, sequence_id="bigint", offset="bigint", ids="binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan, edges, below = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                batch = whole.slice(at, 4096)
                length = batch["length"].to_numpy()
                rank = batch["__position"].to_numpy() - below[length]
                rows, places = [], []
                for n in np.unique(length):
                    mine = np.flatnonzero(length == n)
                    mine = mine[np.argsort(rank[mine], kind="stable")]
                    ranks = rank[mine]
                    # Placements of this length, by first rank; they overlap only where a piece is cut.
                    span = np.arange(edges[n], edges[n + 1])
                    low = np.searchsorted(ranks, plan["first"][span])
                    high = np.searchsorted(ranks, plan["first"][span] + plan["count"][span])
                    for i in np.flatnonzero(high > low):
                        rows.append(mine[low[i] : high[i]])
                        places.append(np.full(high[i] - low[i], span[i]))
                if not rows:
                    continue
                rows, places = np.concatenate(rows), np.concatenate(places)
                own = batch.select(names).take(pa.array(rows))
                new = {c: own[c] for c in names}
                cut, n = plan["cut"][places], plan["length"][places]
                ids = batch["ids"].take(pa.array(rows)).to_pylist()
                crc = own["ids_crc32"].to_numpy().copy()
                for i in np.flatnonzero(n < length[rows]):
                    ids[i] = ids[i][4 * cut[i] : 4 * (cut[i] + n[i])]
                    crc[i] = zlib.crc32(ids[i])
                new["start"] = pa.array(own["start"].to_numpy() + cut)
                new["length"] = pa.array(n)
                new["ids_crc32"] = pa.array(crc)
                new["sequence_id"] = pa.array(plan["sequence"][places] + rank[rows] - plan["first"][places])
                new["offset"] = pa.array(plan["offset"][places])
                new["ids"] = pa.array(ids, pa.binary())
                yield pa.RecordBatch.from_arrays(list(new.values()), names=list(new))

    return placed.mapInArrow(run, schema)
