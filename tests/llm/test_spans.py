"""Sliding sentence spans against a plain Python version."""

import random
import re

import pyarrow as pa
import pytest

from opinionlens.llm.spans import QUIET, WINDOW, dedup_spans
from opinionlens.llm.texthash import words_of


def word_hashes(words):
    """The operator's own hash of each word, on which cuts inside a long sentence depend."""
    return [int(h) for h in words_of(pa.array([" ".join(words)], pa.large_string()), lower=False).hashes]


def sentences(text):
    """(words, raw) of each sentence; raw has the white space behind it."""
    found = [(m[0].rstrip(" \t\n\x0b\x0c\r"), m[0]) for m in re.finditer(r"[^ \t-\r]+[ \t-\r]*", text)]
    words = [w for w, _ in found]
    ends = {i + 1 for i, (w, raw) in enumerate(found) if (w[-1] in ".!?" and raw != w) or "\n" in raw[len(w) :]}
    ends |= {0, len(found)}
    hashes = word_hashes(words) if words else []
    windows = [range(i, i + WINDOW) for i in range(len(words) - WINDOW + 1)]
    least = {i for own in windows for i in own if hashes[i] == min(hashes[j] for j in own)}
    near = lambda cut: any(abs(cut - e) <= QUIET for e in ends)
    cuts = sorted(ends | {i + 1 for i in least if i + 1 < len(words) and not near(i + 1)})
    return [(tuple(words[a:b]), "".join(raw for _, raw in found[a:b])) for a, b in zip(cuts, cuts[1:])]


def brute(docs, min_sentences=2, min_words=20):
    """The shortest runs from each sentence on and up to it, compared by their words; test_spans_runs.py has all runs."""
    spans = {}
    for doc_id, text in sorted(set(docs), key=lambda d: (d[0] is None, d[0] or 0)):
        own = sentences(text or "")
        shortest = set()
        for i in range(len(own)):
            size = 0
            for j in range(i + 1, len(own) + 1):
                size += len(own[j - 1][0])
                if j - i >= min_sentences and size >= min_words:
                    shortest.add((i, j))
                    break
            size = 0
            for j in range(i, -1, -1):
                size += len(own[j][0])
                if i + 1 - j >= min_sentences and size >= min_words:
                    shortest.add((j, i + 1))
                    break
        for i, j in sorted(shortest):
            spans.setdefault(tuple(w for s in own[i:j] for w in s[0]), []).append((doc_id, text, i, j))
    gone = {}
    for places in spans.values():
        for doc_id, text, i, j in places[1:]:
            gone.setdefault((doc_id, text), set()).update(range(i, j))
    out = []
    for doc_id, text in docs:
        own = sentences(text or "")
        cut = gone.get((doc_id, text), set())
        lead = "" if text is None or not own else text[: len(text) - len("".join(r for _, r in own))]
        kept = text if not cut else lead + "".join(r for k, (_, r) in enumerate(own) if k not in cut)
        out.append((doc_id, kept, len(own), len(cut)))
    return out


def random_docs(seed, n=120):
    r = random.Random(seed)
    words = ["alpha", "été", "of", "the", "größe", "x", "end", "run"]
    sentence = lambda: " ".join(r.choice(words) for _ in range(r.randrange(3, 14))) + r.choice([".", "!", "?", ""])
    shared = [" ".join(sentence() for _ in range(6)) for _ in range(5)]
    docs = []
    for i in range(n):
        parts = [r.choice(shared) if r.random() < 0.3 else sentence() for _ in range(r.randrange(0, 8))]
        docs.append((i, r.choice([" ", "\n", "  \n"]).join(parts)))
    return docs


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(spark, seed):
    docs = [*random_docs(seed), (500, None), (501, ""), (502, "   "), (3, "same id, other text. And more of it.")]
    got = dedup_spans(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(brute(docs), key=str)


def test_edge_cases(spark):
    passage = "One two three four five six seven eight nine ten. Eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty."
    rows = [(1, passage, 7), (1, passage, 7), (None, passage, 8), (2, "Start. " + passage + " End.", 9)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, at int")
    got = sorted(((r.doc_id, r.text, r["at"]) for r in dedup_spans(df).collect()), key=str)
    assert got == sorted([(1, passage, 7), (1, passage, 7), (None, "", 8), (2, "Start. End.", 9)], key=str)
    assert dedup_spans(df.limit(0)).collect() == []


def test_long_text_without_marks(spark):
    line = " ".join(f"w{i}" for i in range(60))
    long = "\n".join(" ".join(f"u{j}x{i}" for i in range(40)) for j in range(3000))
    df = spark.createDataFrame([(1, line), (2, "intro\n" + line + "\noutro"), (3, long)], "doc_id bigint, text string")
    got = {r.doc_id: r.text for r in dedup_spans(df).collect()}
    assert got == {1: line, 2: "intro\noutro", 3: long}
