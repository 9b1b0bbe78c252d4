"""Periodic runs of words by recompression.

The words of many texts, with a separator of its own behind each, become one
sequence of numbers. Rounds of block compression (a symbol repeated k times
becomes one) and pair compression (a left symbol before a right one becomes one;
a hash deals symbols to the sides anew in each round) shorten it to a single
symbol. As equal stretches are compressed alike but for their ends, the grammar
answers how far two places agree: a query climbs while both places begin symbols,
and goes down where these differ.

A run of period p and 2p words or more has two neighbouring multiples of p, so
for each period only the places of that grid (n / p of them) are candidates. Where
the words at both ends of a cell are equal, the longest common extensions forwards
and backwards give the whole run. No suffix array is made.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from opinionlens.llm.common import drop_held, release, text_slices, with_fields
from opinionlens.llm.texthash import U64, mix

MIN_LENGTH = 12
#: Candidates whose extensions are asked for at once.
CHUNK = 1 << 18
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def _numbered(first: np.ndarray, second: np.ndarray, start: int) -> tuple[np.ndarray, int]:
    """A number from ``start`` on for each distinct pair of numbers under 2^31, and the next free one."""
    distinct, numbers = np.unique((first << 32) | second, return_inverse=True)
    return numbers + start, start + len(distinct)


class Grammar:
    """Levels of a recompressed sequence whose first and last symbol occur once.

    ``symbols[k]`` is level k; symbol i of level k + 1 stands for the symbols of
    level k from ``starts[k][i]`` up to ``starts[k][i + 1]``, and ``parents[k]``
    leads back up. ``blocks[k]`` tells block from pair compression.
    """

    def __init__(self, symbols: list[np.ndarray], starts: list[np.ndarray], parents: list[np.ndarray], blocks: list[bool]):
        self.symbols, self.starts, self.parents, self.blocks = symbols, starts, parents, blocks

    @classmethod
    def of(cls, words: np.ndarray) -> Grammar:
        own = cls([words.astype(np.int64)], [], [], [])
        free = int(words.max()) + 1
        turn = 0
        while len(own.symbols[-1]) > 1:
            now = own.symbols[-1]
            begins = np.append(True, now[1:] != now[:-1])
            if not begins.all():
                first = np.flatnonzero(begins)
                sizes = np.diff(np.append(first, len(now)))
                above, many = now[first], sizes > 1
                above[many], free = _numbered(above[many], sizes[many], free)
                own._add(above, begins, True)
                now = above
            turn += 1
            left = (mix((now + 1).astype(U64) * U64(0xD6E8FEB86659FD93) + U64(turn)) >> U64(63)) == 0
            here, other = left[:-1] & ~left[1:], ~left[:-1] & left[1:]
            at = np.flatnonzero(other if np.count_nonzero(other) > np.count_nonzero(here) else here)
            if len(at):
                begins = np.ones(len(now), bool)
                begins[at + 1] = False
                above = now.copy()
                above[at], free = _numbered(now[at], now[at + 1], free)
                own._add(above[begins], begins, False)
        return own

    def _add(self, symbols: np.ndarray, begins: np.ndarray, block: bool) -> None:
        self.starts.append(np.append(np.flatnonzero(begins), len(begins)))
        self.parents.append(np.cumsum(begins) - 1)
        self.symbols.append(symbols)
        self.blocks.append(block)

    def mirror(self) -> Grammar:
        """The same grammar read from the end."""
        starts = [s[-1] - s[::-1] for s in self.starts]
        parents = [p[-1] - p[::-1] for p in self.parents]
        return Grammar([s[::-1] for s in self.symbols], starts, parents, self.blocks)

    def extend(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols from ``i`` and from ``j`` on are equal, for each pair of different places."""
        a, b, query = i.astype(np.int64), j.astype(np.int64), np.arange(len(i))
        stopped = []
        for level, symbols in enumerate(self.symbols):
            on = symbols[a] == symbols[b]
            stopped.append((a[~on], b[~on], query[~on]))
            a, b, query = a[on], b[on], query[on]
            if not len(a):
                break
            starts, parent_a, parent_b = self.starts[level], self.parents[level][a], self.parents[level][b]
            inside = (starts[parent_a] != a) | (starts[parent_b] != b)
            # Both hold the same symbol: what is left of a block, or the second one of a pair, is passed together.
            left_a, left_b = starts[parent_a + 1] - a, starts[parent_b + 1] - b
            uneven = inside & (left_a != left_b)
            step = np.minimum(left_a, left_b)[uneven]
            stopped[level] = tuple(
                np.append(x, y) for x, y in zip(stopped[level], (a[uneven] + step, b[uneven] + step, query[uneven]), strict=True)
            )
            up = ~uneven
            a, b, query = parent_a[up] + inside[up], parent_b[up] + inside[up], query[up]
        a, b, query = (np.zeros(0, np.int64) for _ in range(3))
        for level in range(len(stopped) - 1, -1, -1):
            if len(a):
                starts, symbols = self.starts[level], self.symbols[level]
                size = np.minimum(starts[a + 1] - starts[a], starts[b + 1] - starts[b]) if self.blocks[level] else 1
                a, b = starts[a], starts[b]
                step = np.where(symbols[a] == symbols[b], size, 0)
                a, b = a + step, b + step
            a, b, query = (np.append(x, y) for x, y in zip((a, b, query), stopped[level], strict=True))
        out = np.zeros(len(i), np.int64)
        out[query] = a
        return out - i


def periodic_runs(words: np.ndarray, longest: int, min_length: int = MIN_LENGTH) -> np.ndarray:
    """Rows (start, end, period) of all maximal runs of at least ``min_length`` words and two periods.

    ``words`` are numbers; its first and last one and those between texts occur
    once. ``longest`` is the length of the longest text.
    """
    n = len(words)
    found = np.zeros((0, 3), np.int64)
    if longest < min_length:
        return found
    grammar = Grammar.of(words)
    back = grammar.mirror()
    known = np.zeros((3, n), np.int64)  # start, end and period of a long run over each place
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def answer() -> np.ndarray:
        at, period = (np.concatenate([h[k] for h in held]) for k in (0, 1))
        held.clear()
        start = at - back.extend(n - at, n - at - period)
        end = at + period + grammar.extend(at, at + period)
        keep = end - start >= np.maximum(min_length, 2 * period)
        rows = np.unique(np.stack([start, end, period], axis=1)[keep], axis=0)
        long = rows[rows[:, 1] - rows[:, 0] >= np.maximum(4 * rows[:, 2], 64)]
        for s, e, p in long[np.argsort(long[:, 1] - long[:, 0], kind="stable")]:
            known[:, s:e] = np.array([[s], [e], [p]])
        return rows

    size = 0
    for period in range(1, longest // 2 + 1):
        at = np.flatnonzero(words[: n - period : period] == words[period::period]) * period
        # Of the equal places around a cell there are six or more, so one beside its end is equal too.
        at = at[(words[at + 1] == words[at + period + 1]) | (words[at - 1] == words[at + period - 1])]
        # In a run of a period that divides this one, of two of this one's lengths, it finds that run again.
        start, end, own = known[:, at]
        at = at[(own == 0) | (period % np.maximum(own, 1) != 0) | (end - start < 2 * period) | (at + period >= end)]
        if len(at):
            held.append((at, np.full(len(at), period)))
            size += len(at)
        if size >= CHUNK or (held and period & (period - 1) == 0):
            found, size = np.concatenate([found, answer()]), 0
    if held:
        found = np.concatenate([found, answer()])
    # The same stretch was found with multiples of its smallest period too.
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    same = np.zeros(len(found), bool)
    same[1:] = (found[1:, 0] == found[:-1, 0]) & (found[1:, 1] == found[:-1, 1])
    found = found[~same]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def find_runs(docs: DataFrame, text: str = "text", min_length: int = MIN_LENGTH) -> DataFrame:
    """Add n_words, runs and collapsed to every row, instead of its text.

    ``runs`` are the start (word number from 0), length and smallest period of
    every maximal run of ``min_length`` words and two periods or more, by start,
    then period. ``collapsed`` has the words that no run repeats, joined by
    blanks: those that no run contains after its first period. Null and empty
    texts have no words, no runs and an empty collapsed text. Repeated rows are
    each searched; an empty table gives an empty one. Columns of ``docs`` named
    like an added one are replaced.
    """
    if min_length < MIN_LENGTH:
        raise ValueError(f"min_length must be {MIN_LENGTH} at least")
    added = ("n_words", "runs", "collapsed")
    names = [c for c in docs.columns if c not in (text, *added)]
    schema = with_fields(docs.select(*names).schema, n_words="bigint", runs=RUNS, collapsed="string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_held()
        for whole in batches:
            for batch, texts in text_slices(whole, text):
                words = [t.as_buffer().to_pybytes().split() for t in texts]  # blank and x09 to x0D, as in the bytes
                numbers: dict[bytes, int] = {}
                sizes = np.array([len(w) for w in words], np.int64)
                firsts = np.cumsum(sizes + 1) - sizes  # a separator before each text and one at the end
                flat = np.full(int(sizes.sum()) + len(words) + 1, -1, np.int64)
                for first, own in zip(firsts, words, strict=True):
                    flat[first : first + len(own)] = [numbers.setdefault(w, len(numbers)) for w in own]
                gaps = np.flatnonzero(flat < 0)
                flat[gaps] = np.arange(len(gaps)) + len(numbers)
                found = periodic_runs(flat, int(sizes.max()), min_length)
                row = np.searchsorted(firsts, found[:, 0], side="right") - 1
                offsets = np.searchsorted(row, np.arange(len(words) + 1))
                gone = np.zeros(len(flat) + 1, np.int64)
                np.add.at(gone, found[:, 0] + found[:, 2], 1)
                np.add.at(gone, found[:, 1], -1)
                gone = np.cumsum(gone) > 0
                collapsed = []
                for first, own, n_runs in zip(firsts, words, np.diff(offsets), strict=True):
                    kept = own if not n_runs else [own[i] for i in np.flatnonzero(~gone[first : first + len(own)])]
                    collapsed.append(b" ".join(kept).decode())
                columns = [found[:, 0] - firsts[row], found[:, 1] - found[:, 0], found[:, 2]]
                runs = pa.StructArray.from_arrays([pa.array(c) for c in columns], names=["start", "length", "period"])
                new = [pa.array(sizes), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), runs), pa.array(collapsed, pa.string())]
                yield pa.RecordBatch.from_arrays([*(batch[c] for c in names), *new], names=[*names, *added])
        release()

    return docs.select(text, *names).mapInArrow(run, schema)
