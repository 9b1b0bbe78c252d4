"""Vectorised 64-bit hashes of words and of runs of words, with numpy.

A word is a maximal run of bytes other than blank and x09 to x0D, so it is
found in the UTF-8 bytes without decoding. Each byte value has a fixed random
64-bit code; a word's hash is the polynomial of its codes, read off a running
sum, and mixed. Words of over 64 bytes, for which such polynomials can be made
to collide on purpose, take xxh3 instead.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

from opinionlens.llm.common import worker_cache

BASE = 0x9E3779B97F4A7C15
LONG_WORD = 64
#: Powers that a worker keeps, 16 bytes each: enough for a slice of texts.
KEPT_POWERS = 1 << 22
U64 = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over all 64 output bits."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _codes(lower: bool) -> np.ndarray:
    values = np.arange(256, dtype=U64)
    if lower:
        upper = (values >= 65) & (values <= 90)
        values = np.where(upper, values + U64(32), values)
    return mix((values + U64(1)) * U64(0xD6E8FEB86659FD93))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse modulo 2^64, ``n`` at least."""
    cache = worker_cache()
    held = cache.get("powers")
    if held is None or len(held[0]) < n:
        size = 1 << max(16, int(n - 1).bit_length())  # of a text longer than all slices the next call makes its own
        up, down = np.full(size, BASE, U64), np.full(size, pow(BASE, -1, 1 << 64), U64)
        up[0] = down[0] = 1
        held = np.cumprod(up, dtype=U64), np.cumprod(down, dtype=U64)
        if size <= KEPT_POWERS:
            cache["powers"] = held
    return held


@dataclass
class Words:
    """Words of several texts: hash, number of the text, and byte span in ``data``."""

    hashes: np.ndarray
    rows: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    data: np.ndarray
    n_rows: int

    @property
    def counts(self) -> np.ndarray:
        return np.bincount(self.rows, minlength=self.n_rows)


def byte_view(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a ``large_string`` array without nulls, and the offsets of its texts."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    """Hash of each byte span of ``data``."""
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, U64)
    np.cumsum(_codes(lower)[data] * up[: len(data)], dtype=U64, out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U64))
    for i in np.flatnonzero(ends - starts > LONG_WORD):
        span = data[starts[i] : ends[i]].tobytes()
        hashes[i] = xxhash.xxh3_64_intdigest(span.lower() if lower else span)
    return hashes


def words_of(texts: pa.Array, lower: bool) -> Words:
    """Words of each text; A-Z count as a-z if ``lower``."""
    data, offsets = byte_view(texts)
    solid = (data != 32) & ((data < 9) | (data > 13))
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:] = solid[:-1]
    after[:-1] = solid[1:]
    starts = np.flatnonzero(solid & (~before | first[:-1]))
    ends = np.flatnonzero(solid & (~after | first[1:])) + 1
    rows = np.searchsorted(offsets, starts, side="right") - 1
    return Words(hash_spans(data, starts, ends, lower), rows, starts, ends, data, len(texts))


def run_hashes(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``k`` words within one text, and the number of its text."""
    n = len(words.hashes) - k + 1
    if n <= 0:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    total = np.zeros(n, U64)
    for j in range(k):  # an odd multiplier for each place
        total += words.hashes[j : j + n] * U64(pow(0x2545F4914F6CDD1D, j + 1, 1 << 64))
    inside = words.rows[:n] == words.rows[k - 1 :]
    return mix(total[inside]), words.rows[:n][inside]
