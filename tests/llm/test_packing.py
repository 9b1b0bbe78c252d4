"""Packing: ids of the tokenizers library, each in one piece, windows without gaps."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
import tokenizers  # noqa: E402

from opinionlens.llm.packing import WordTokenizer, filling_combinations, pack, plan_packing, repeat_counts  # noqa: E402

FILE = public_tokenizers.path("byte_bpe_50k.json")


def check(pieces, texts, window):
    library = tokenizers.Tokenizer.from_file(FILE)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    assert by_doc.keys() == texts.keys()
    for doc_id, own in by_doc.items():
        ids = np.array([*library.encode(texts[doc_id] or "", add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for p in sorted(own, key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            assert p.ids is None or p.ids == ids[at : at + p.length].tobytes()
            at += p.length
        assert at == len(ids)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= window
    return len(by_sequence)


@pytest.mark.parametrize("window", [16, 1024])
def test_random_documents(spark, window):
    r = random.Random(5)
    texts = {i: " ".join(r.choice(["alpha", "beta", "été", "12", "\n"]) for _ in range(r.randrange(0, 900))) for i in range(90)}
    texts |= {200: None, 201: "", 202: "same " * 40, 203: "same " * 40, 204: "x" * 300_000, 205: "a <|endoftext|>  b"}
    df = spark.createDataFrame([(i, t, 1) for i, t in texts.items()], "doc_id bigint, text string, length int").repartition(4)
    pieces = pack(df, FILE, window=window).collect()
    n = check(pieces, texts, window)
    total = sum(p.length for p in pieces)
    assert n <= 1.02 * total / window + 1


def test_nulls_repeats_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c")], "doc_id bigint, text string")
    got = pack(df, FILE).collect()
    assert sorted((str(p.doc_id), p.length, p.sequence_id) for p in got) == [("1", 3, 0), ("1", 3, 0), ("None", 2, 0)]
    assert len({p.offset for p in got}) == 3
    assert pack(df.limit(0), FILE).collect() == []


def test_tokenizer_matches_the_library():
    r, own, library = random.Random(1), WordTokenizer(FILE), tokenizers.Tokenizer.from_file(FILE)
    letters = [*"abcd  \n\t.,'sé日🙂\x00<>01A\xa0\x1c\u2003 ", "<|endoftext|>", "'ll", " <|endoftext|>"]
    for _ in range(4000):
        text = "".join(r.choice(letters) for _ in range(r.randrange(0, 24)))
        assert np.frombuffer(own.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("lengths", [[700] * 500, list(range(1, 1024)), [1024] * 3 + [1], [512] * 7, [300, 800] * 200])
def test_plans_cover_every_piece_once(lengths):
    histogram = np.bincount(lengths, minlength=1025)
    covered, filled = defaultdict(int), defaultdict(int)
    for p in plan_packing(histogram, 1024, 16):
        for i in range(p.count):
            covered[p.bin, p.first + i] += p.length
            filled[p.sequence + i] += p.length
    assert covered == {(n, i): n for n in set(lengths) for i in range(lengths.count(n))}
    assert max(filled.values()) <= 1024 and len(filled) <= 1.02 * sum(lengths) / 1024 + 1


def test_least_squares():
    combinations = filling_combinations(np.array([200, 400, 424, 600]), 1024)
    assert sorted(map(tuple, combinations)) == [(0, 424, 600), (200, 400, 424)]
    histogram = np.zeros(1025, int)
    histogram[[200, 400, 424, 600]] = 30, 30, 80, 50
    counts = dict(zip(map(tuple, combinations), repeat_counts(combinations, histogram)))
    assert abs(counts[0, 424, 600] - 50) < 0.5 and abs(counts[200, 400, 424] - 30) < 0.5
