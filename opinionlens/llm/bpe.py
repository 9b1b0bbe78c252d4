"""Exact merge-type (BPE) encoding by backtracking, and decoding.

Within a chunk (blanks and the characters up to the next blank; no piece
crosses such a border) an Aho-Corasick automaton gives all pieces that start at
each place, longest first. Pieces are taken greedily. Each new piece must be
compatible with the one before: merging the joined text of the two alone must
give the two back. If no piece fits, the last one is shortened or taken back,
and its end is marked in a bitfield, since the encoding of a prefix is unique and
a border that failed once always fails. A sequence whose neighbours are all
compatible is the encoding that merging the whole text gives.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame

from opinionlens.llm.common import with_fields, worker_held

SPACE = "▁"
#: Chunks and piece pairs that a worker remembers; beyond it, it starts afresh.
MAX_CHUNKS = 800_000
MAX_PAIRS = 1_000_000

_WORD = re.compile(f"({SPACE}?[^\\W_]+)([\\W_][^{SPACE}]*)")
_CHUNKS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


class PieceEncoder:
    """Encoder of a piece model with byte fallback and a blank put before each text."""

    def __init__(self, model_file: str):
        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        ids = range(model.get_piece_size())
        self.bos, self.eos = model.bos_id(), model.eos_id()
        plain = [i for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        self.id_of = {model.id_to_piece(i): i for i in plain}
        self.score = {model.id_to_piece(i): model.get_score(i) for i in plain}
        self.byte_id = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.characters = {c for piece in self.id_of for c in piece}
        if self.characters - self.id_of.keys():
            raise ValueError("a piece has a character that is no piece of its own")
        if any(SPACE in p.strip(SPACE) or (SPACE in p[1:] and p.strip(SPACE)) for p in self.id_of):
            raise ValueError("a piece crosses a border of chunks")
        if any(model.normalize(c) != SPACE + c for c in ("ﬁ", "Å", "  ", "\t", "A") if c.strip()):
            raise ValueError("the model changes texts before it encodes them")
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.id_of.items():
            if self.merge(piece) == [piece]:
                self.automaton.add_word(piece, (len(piece), i, piece))
        self.automaton.make_automaton()
        self.chunks: dict[str, bytes] = {}
        self.pairs: dict[int, bool] = {}
        self.piece_of = {i: (len(p), i, p) for p, i in self.id_of.items()}
        self.piece_bytes = [b""] * len(ids)
        for i in ids:
            if model.is_byte(i):
                self.piece_bytes[i] = bytes([int(model.id_to_piece(i)[3:5], 16)])
            elif model.is_unknown(i):
                self.piece_bytes[i] = model.decode([i]).encode()
            elif not model.is_control(i):
                self.piece_bytes[i] = model.id_to_piece(i).replace(SPACE, " ").encode()

    def merge(self, text: str) -> list[str]:
        """Join the neighbours whose joined piece scores best, leftmost first, until none is a piece."""
        parts = list(text)
        while len(parts) > 1:
            best = max(
                ((self.score[a + b], -i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.score),
                default=None,
            )
            if best is None:
                break
            i = -best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def _check(self, left: tuple, right: tuple) -> bool:
        """Are two neighbours what merging their joined text gives? The answer is kept."""
        if len(self.pairs) >= MAX_PAIRS:
            self.pairs.clear()
        known = self.merge(left[2] + right[2]) == [left[2], right[2]]
        self.pairs[left[1] << 32 | right[1]] = known
        return known

    def _known(self, text: str) -> list[int]:
        """Ids of a text whose characters are all pieces."""
        n = len(text)
        starting: list[list[tuple]] = [[] for _ in range(n)]
        for end, piece in self.automaton.iter(text):
            starting[end + 1 - piece[0]].append(piece)  # shorter pieces first, as their ends come first
        pairs = self.pairs
        failed = bytearray(n + 1)
        taken: list[tuple] = []
        tries: list[int] = []  # how many pieces are left to try at each place
        at, left, last = 0, len(starting[0]), -1
        while at < n:
            here = starting[at]
            while left:
                left -= 1
                piece = here[left]
                if failed[at + piece[0]]:
                    continue
                if last >= 0:
                    fits = pairs.get(last << 32 | piece[1])
                    if not (self._check(taken[-1], piece) if fits is None else fits):
                        continue
                taken.append(piece)
                tries.append(left)
                at += piece[0]
                last = piece[1]
                left = len(starting[at]) if at < n else 0
                break
            else:
                failed[at] = 1
                at -= taken.pop()[0]
                left = tries.pop()
                last = taken[-1][1] if taken else -1
        return [piece[1] for piece in taken]

    def _joined(self, chunk: str) -> bytes | None:
        """Encoding of a word with other characters after it, if the border between the two holds."""
        if not (parts := _WORD.fullmatch(chunk)):
            return None
        first, second = (self._remembered(x) for x in parts.groups())
        left, right = int.from_bytes(first[-4:], "little"), int.from_bytes(second[:4], "little")
        fits = self.pairs.get(left << 32 | right)
        if fits is None and left in self.piece_of and right in self.piece_of:
            fits = self._check(self.piece_of[left], self.piece_of[right])
        return first + second if fits else None

    def _remembered(self, chunk: str) -> bytes:
        known = self.chunks.get(chunk)
        if known is None:
            known = self._joined(chunk) or self.encode_chunk(chunk)
            if len(self.chunks) >= MAX_CHUNKS:
                self.chunks.clear()
            self.chunks[chunk] = known
        return known

    def encode_chunk(self, chunk: str) -> bytes:
        """Ids of a chunk as little-endian unsigned 32-bit integers."""
        ids: list[int] = []
        if self.characters.issuperset(chunk):
            ids = self._known(chunk)
        else:  # a character without a piece never merges: its bytes stand alone
            held = ""
            for c in chunk:
                if c in self.characters:
                    held += c
                    continue
                ids += self._known(held) if held else []
                ids += [self.byte_id[b] for b in c.encode()]
                held = ""
            ids += self._known(held) if held else []
        return np.asarray(ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """Ids of a whole text, without begin and end."""
        if not text:
            return b""
        parts = _CHUNKS.findall(SPACE + text.replace(" ", SPACE))
        chunks = self.chunks
        out = list(map(chunks.get, parts))
        if None in out:
            for i, known in enumerate(out):
                if known is None:
                    out[i] = self._remembered(parts[i])
        return b"".join(out)

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids; controls are left out, as is the blank put before the text.

        A byte that is no part of valid UTF-8 becomes U+FFFD.
        """
        listed = ids.tolist()
        raw = b"".join(map(self.piece_bytes.__getitem__, listed))
        if raw[:1] == b" " and next(i for i in listed if self.piece_bytes[i]) in self.piece_of:
            raw = raw[1:]
        try:
            return raw.decode()
        except UnicodeDecodeError:
            return "".join(_decoded(raw))


def _decoded(raw: bytes) -> Iterator[str]:
    """Valid UTF-8 as it is, and U+FFFD for each other byte."""
    at = 0
    while at < len(raw):
        try:
            yield raw[at:].decode()
            return
        except UnicodeDecodeError as e:
            yield raw[at : at + e.start].decode()
            yield "�"
            at += e.start + 1


def encode_texts(
    docs: DataFrame, model_file: str, text: str = "text", ids: bool = True, digests: bool = False
) -> DataFrame:
    """Encode every whole text with begin and end ids, and decode it.

    Adds ``n_tokens``, with ``ids`` also ``ids`` (array) and ``decoded``, with
    ``digests`` ``ids_sha256`` and ``decoded_sha256``. Null and empty texts have
    the two ids and an empty decoded text. All other columns stay; those named
    like an added one are replaced. Repeated rows are each encoded. The
    automaton and the model are built in each worker process from
    ``model_file``, a path that every executor can read.
    """
    kinds = {"n_tokens": "bigint"}
    kinds |= {"ids": "array<int>", "decoded": "string"} if ids else {}
    kinds |= {"ids_sha256": "string", "decoded_sha256": "string"} if digests else {}
    kept = docs.select(text, *[c for c in docs.columns if c not in kinds and c != text])
    schema = with_fields(kept.schema, **kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = worker_held(("pieces", model_file), lambda: PieceEncoder(model_file))
        begin, end = (np.asarray([x], "<u4").tobytes() for x in (own.bos, own.eos))
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                encoded = [begin + own.encode(t) + end for t in pc.fill_null(batch[text], "").to_pylist()]
                arrays = [np.frombuffer(e, "<u4") for e in encoded]
                decoded = [own.decode(a) for a in arrays]
                new = {"n_tokens": pa.array([len(a) for a in arrays], pa.int64())}
                if ids:
                    new["ids"] = pa.array([a.astype(np.int32) for a in arrays], pa.list_(pa.int32()))
                    new["decoded"] = pa.array(decoded, pa.string())
                if digests:
                    new["ids_sha256"] = pa.array([hashlib.sha256(e).hexdigest() for e in encoded], pa.string())
                    new["decoded_sha256"] = pa.array([hashlib.sha256(d.encode()).hexdigest() for d in decoded], pa.string())
                columns = [*batch.columns, *(new[k] for k in kinds)]
                yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, *kinds])

    return kept.mapInArrow(run, schema)
