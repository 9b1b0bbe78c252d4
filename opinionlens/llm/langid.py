"""Language identification by cross-parsing entropy.

For each language a suffix automaton is built of labelled text. A document is
parsed into the longest phrases that occur in the language's text; the language
that needs the fewest phrases, weighted by the logarithm of its text's length (the
cost of naming a place in it), wins. Texts are letters in lower case with all else
as one blank. The alphabet is all letters of the labelled texts.

Texts are parsed whole. So that numpy follows many places and all languages at
once, a long text is first parsed from the begin of each of its blocks; then each
block's parse is carried on into the next ones until it is in the state that was
found there, from where on both are the same.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinionlens.llm.common import text_slices, with_fields, worker_cache, worker_held

UNDETERMINED = "und"
BLOCK = 512
#: Cells of (language, character) that are parsed at once.
CELLS = 8 << 20
#: Largest array of transitions by state and code; beyond it they are hashed. Both give the same phrases.
DENSE_BYTES = 128 << 20
#: Codes: 0 what is no letter, 1 a letter that no labelled text has, from 2 on the alphabet.
FIRST_LETTER = 2


@dataclass(frozen=True)
class LanguageSamples:
    """Labelled text of each language."""

    texts: tuple[tuple[str, str], ...]


def sample_languages(
    docs: DataFrame,
    where: Column,
    text: str = "text",
    lang: str = "lang",
    order: str = "doc_id",
    rows: int = 60,
    chars: int = 600,
    max_languages: int = 100,
) -> LanguageSamples:
    """Text of ``rows`` labelled rows of each language, ``chars`` characters of each.

    The rows are those that ``where`` admits with the smallest hash of
    ``order``. They bound what reaches the driver: rows x chars x
    ``max_languages`` characters; more languages raise an error.
    """
    admitted = docs.filter(where & F.col(lang).isNotNull() & F.col(text).rlike("\\p{L}"))
    by_hash = Window.partitionBy(lang).orderBy(F.xxhash64(order), F.xxhash64(text))
    picked = admitted.select(lang, order, text).withColumn("__rank", F.row_number().over(by_hash)).filter(F.col("__rank") <= rows)
    found: dict[str, list[str]] = {}
    for row in picked.select(lang, "__rank", F.substring(text, 1, chars).alias("t")).limit(rows * max_languages + 1).collect():
        found.setdefault(row[lang], []).append((row["__rank"], row["t"]))
    if len(found) > max_languages:
        raise ValueError(f"over {max_languages} languages")
    return LanguageSamples(tuple((name, " ".join(t for _, t in sorted(ts))) for name, ts in sorted(found.items())))


def suffix_automaton(codes: list[int]) -> list[dict[int, int]]:
    """Transitions (code to state) of each state of the suffix automaton of ``codes``; no transition leads to state 0."""
    links, lengths, moves = [-1], [0], [{}]
    last = 0
    for code in codes:
        new = len(moves)
        moves.append({})
        lengths.append(lengths[last] + 1)
        links.append(0)
        at = last
        while at >= 0 and code not in moves[at]:
            moves[at][code] = new
            at = links[at]
        if at >= 0:
            old = moves[at][code]
            if lengths[old] == lengths[at] + 1:
                links[new] = old
            else:
                copy = len(moves)
                moves.append(dict(moves[old]))
                lengths.append(lengths[at] + 1)
                links.append(links[old])
                while at >= 0 and moves[at].get(code) == old:
                    moves[at][code] = copy
                    at = links[at]
                links[old] = links[new] = copy
        last = new
    return moves


class Transitions:
    """Transitions of all automata as one open hash table of sorted-out arrays, for alphabets of any size."""

    FACTOR = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, keys: np.ndarray, targets: np.ndarray):
        bits = max(4, int(2 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.targets = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int32)
        left, slot = np.arange(len(keys)), self._slot(keys)
        while len(left):  # of several for one free place the first gets it, the others go on to the next place
            free = np.flatnonzero(self.keys[slot] < 0)
            own = free[np.unique(slot[free], return_index=True)[1]]
            self.keys[slot[own]], self.targets[slot[own]] = keys[left[own]], targets[left[own]]
            rest = np.ones(len(left), bool)
            rest[own] = False
            left, slot = left[rest], (slot[rest] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * self.FACTOR) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Target of each key; 0 where there is none."""
        shape, keys = keys.shape, keys.ravel()
        slot = self._slot(keys)
        held = self.keys[slot]
        out = np.where(held == keys, self.targets[slot], 0)
        left = np.flatnonzero((held != keys) & (held >= 0))
        slot = slot[left]
        while len(left):
            slot = (slot + 1) & self.mask
            held, wanted = self.keys[slot], keys[left]
            hit = held == wanted
            out[left[hit]] = self.targets[slot[hit]]
            on = ~hit & (held >= 0)
            left, slot = left[on], slot[on]
        return out.reshape(shape)


class DenseTransitions:
    """The same as one array by state and code, which one gather reads."""

    def __init__(self, keys: np.ndarray, targets: np.ndarray, cells: int):
        self.targets = np.zeros(cells, np.int32)
        self.targets[keys] = targets

    def find(self, keys: np.ndarray) -> np.ndarray:
        return self.targets[keys]


class CrossParser:
    """Parses texts by the automata of all languages at once."""

    def __init__(self, texts: Sequence[tuple[str, str]]):
        self.names = [name for name, _ in texts]
        self.codes = _letters().copy()
        alphabet = sorted({ord(c) for _, t in texts for c in t.lower() if c.isalpha()})
        self.codes[alphabet] = np.arange(FIRST_LETTER, FIRST_LETTER + len(alphabet))
        self.width = FIRST_LETTER + len(alphabet)
        keys, targets, self.roots, self.weights, at = [], [], [], [], 0
        for _, text in texts:
            codes = self.encode(text)
            moves = suffix_automaton(codes.tolist())
            sizes = np.array([len(m) for m in moves])
            inner = np.fromiter((c for m in moves for c in m), np.int64, sizes.sum())
            keys.append(np.repeat(np.arange(at, at + len(moves)), sizes) * self.width + inner)
            targets.append(np.fromiter((t for m in moves for t in m.values()), np.int64, sizes.sum()) + at)
            self.roots.append(at)
            self.weights.append(np.log2(max(len(codes), 2)))
            at += len(moves)
        empty = np.zeros(0, np.int64)
        all_keys, all_targets = np.concatenate([*keys, empty]), np.concatenate([*targets, empty]).astype(np.int32)
        dense = 4 * at * self.width <= DENSE_BYTES
        self.moves = DenseTransitions(all_keys, all_targets, at * self.width) if dense else Transitions(all_keys, all_targets)
        codes = np.arange(self.width)
        from_root = [np.where(t > 0, t, root) for root in self.roots for t in [self.moves.find(root * self.width + codes)]]
        self.from_root = np.array(from_root, np.int64).reshape(-1)

    def encode(self, text: str) -> np.ndarray:
        points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = self.codes[points]
        keep = np.ones(len(codes), bool)
        keep[1:] = (codes[1:] > 0) | (codes[:-1] > 0)
        return codes[keep]

    def step(self, state: np.ndarray, lang: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """State after a code, and whether a new phrase begins with it.

        A code that the language never has is a phrase of its own; the next one starts at the root.
        """
        target = self.moves.find(state * self.width + code)
        missed = target == 0
        return np.where(missed, self.from_root[lang * self.width + code], target), missed

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Phrases that each text needs in each language, and letters of each text."""
        encoded = [self.encode(t) for t in texts]
        letters = np.array([np.count_nonzero(c) for c in encoded], np.int64)
        total = np.zeros((len(self.names), len(texts)), np.int64)
        filled = [i for i, c in enumerate(encoded) if len(c)]
        limit = CELLS // max(1, len(self.names))
        at = 0
        while self.names and at < len(filled):
            end, size = at, 0
            while end < len(filled) and (end == at or size + len(encoded[filled[end]]) <= limit):
                size += len(encoded[filled[end]])
                end += 1
            total[:, filled[at:end]] = self._parse([encoded[i] for i in filled[at:end]])
            at = end
        return total, letters

    def _parse(self, encoded: list[np.ndarray]) -> np.ndarray:
        sizes = np.array([len(c) for c in encoded])
        flat = np.concatenate(encoded).astype(np.int64)
        ends, n_langs = np.cumsum(sizes), len(self.names)
        begin = np.concatenate([np.arange(e - n, e, BLOCK) for n, e in zip(sizes, ends, strict=True)])
        rows = np.repeat(np.arange(len(sizes)), -(-sizes // BLOCK))
        length = np.minimum(BLOCK, ends[rows] - begin)
        order = np.argsort(-length, kind="stable")
        active = np.searchsorted(-length[order], -np.arange(BLOCK), side="left")  # blocks of over j codes
        # Cells lie by place in the block, then block from long to short, so that each step writes one run.
        steps, place = np.concatenate([[0], np.cumsum(active)]), np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        states, begun = np.zeros((n_langs, len(flat)), np.int32), np.zeros((n_langs, len(flat)), np.int16)
        langs = np.arange(n_langs)[:, None]
        state = np.repeat(np.array(self.roots, np.int64)[:, None], len(begin), axis=1)
        count, starts = np.zeros((n_langs, len(begin)), np.int16), begin[order]
        for j in range(int(length.max())):
            m = active[j]
            state, new = self.step(state[:, :m], langs, flat[starts[:m] + j])
            count = count[:, :m] + new
            states[:, steps[j] : steps[j + 1]], begun[:, steps[j] : steps[j + 1]] = state, count
        in_block = begun[:, steps[length - 1] + place].astype(np.int64)  # phrases begun in each block
        meet, more = self._carry_on(flat, begin, rows, ends, lambda lang, block, at: states[lang, steps[at - begin[block]] + place[block]])
        first = np.searchsorted(rows, np.arange(len(sizes) + 1))
        total = 1 + in_block[:, first[:-1]]
        lang, row = (x.ravel() for x in np.indices(total.shape))
        block = first[row]
        on = np.flatnonzero(block < first[row + 1] - 1)
        while len(on):
            lang, row, block = lang[on], row[on], block[on]
            total[lang, row] += more[lang, block]
            at = meet[lang, block]
            on = np.flatnonzero(at < ends[row])
            lang, row, at = lang[on], row[on], at[on]
            block = first[row] + (at - begin[first[row]]) // BLOCK
            total[lang, row] += in_block[lang, block] - begun[lang, steps[at - begin[block]] + place[block]]
            on = np.flatnonzero(block < first[row + 1] - 1)
        return total

    def _carry_on(
        self, flat: np.ndarray, begin: np.ndarray, rows: np.ndarray, ends: np.ndarray, state_at: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]
    ) -> tuple[np.ndarray, np.ndarray]:
        """Where the parse of each block, carried on, meets that of a later block of its text, and the phrases begun until then.

        Without such a place it is the text's end. ``state_at`` gives the states of the blocks' own parses.
        """
        n_langs = len(self.names)
        inner = np.flatnonzero(rows[:-1] == rows[1:])
        meet, more = np.tile(ends[rows], (n_langs, 1)), np.zeros((n_langs, len(begin)), np.int64)
        lang, block = np.repeat(np.arange(n_langs), len(inner)), np.tile(inner, n_langs)
        end, at, own = ends[rows[block]], begin[block + 1], block + 1
        state = state_at(lang, block, at - 1).astype(np.int64)
        while len(block):
            state, new = self.step(state, lang, flat[at])
            more[lang, block] += new
            same = state_at(lang, own, at) == state
            meet[lang[same], block[same]] = at[same]
            at = at + 1
            on = np.flatnonzero(~same & (at < end))
            lang, block, own, at, state, end = lang[on], block[on], own[on], at[on], state[on], end[on]
            own = own + ((at - begin[own]) >= BLOCK)
        return meet, more


def _letters() -> np.ndarray:
    """1 for each code point that is a letter."""
    cache = worker_cache()
    if "letters" not in cache:
        cache["letters"] = np.array([chr(i).isalpha() for i in range(0x110000)], np.int32)
    return cache["letters"]


def identify_languages(docs: DataFrame, samples: LanguageSamples, text: str = "text") -> DataFrame:
    """Add ``lang_pred``, ``score`` (1 less best cost by second-best cost) and ``phrase_letters`` to every row.

    ``phrase_letters`` is the mean number of letters of a phrase. Null and empty
    texts and those without a letter give ``und``, score 0 and 0 letters, as do
    all texts where nothing was learned. Ties go to the smaller language name.
    Repeated rows are each judged; an empty table gives an empty one. Columns of
    ``docs`` named like an added one are replaced.
    """
    added = ("lang_pred", "score", "phrase_letters")
    names = [c for c in docs.columns if c not in added]
    schema = with_fields(docs.select(*names).schema, lang_pred="string", score="double", phrase_letters="double")
    # Plain tuples: broadcasts are pickled by reference to their classes, which workers may not be able to import.
    shared = docs.sparkSession.sparkContext.broadcast(samples.texts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = worker_held(("languages", hash(shared.value)), lambda: CrossParser(shared.value))
        for whole in batches:
            for batch, texts in text_slices(whole, text):
                phrases, letters = parser.phrases(texts.to_pylist())
                known = (letters > 0) & bool(parser.names)
                pred, score, per_phrase = np.full(batch.num_rows, UNDETERMINED, object), np.zeros(batch.num_rows), np.zeros(batch.num_rows)
                if parser.names:
                    cost = phrases * np.array(parser.weights)[:, None]
                    best = np.argmin(cost, axis=0)
                    ordered = np.sort(cost, axis=0)
                    pred[known] = np.array(parser.names, object)[best][known]
                    if len(parser.names) > 1:
                        score[known] = 1 - ordered[0][known] / ordered[1][known]
                    else:
                        score[known] = 1.0
                    per_phrase[known] = letters[known] / phrases[best, np.arange(batch.num_rows)][known]
                new = [pa.array(pred, pa.string()), pa.array(score), pa.array(per_phrase)]
                yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=[*names, *added])

    return docs.select(*names).mapInArrow(run, schema)
