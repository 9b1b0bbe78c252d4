"""Licence scan against a plain Python version."""

import math
import random
from collections import Counter

from opinionlens.llm.licences import ANCHOR, HEADERS, NAMED, NOTICES, full_texts, scan_licences, spdx_licence, terms_of


def brute(files, threshold=0.7):
    n = len(files)
    df = Counter(t for _, text in files for t in set(terms_of(text or "")))
    vocabulary = {t for _, x in NOTICES for t in terms_of(x)}
    idf = lambda t: 1 + math.log((1 + n) / (1 + (df[t] if t in vocabulary else 0)))
    vector = lambda x: {t: c * idf(t) for t, c in Counter(terms_of(x)).items()}

    def cosine(a, b):
        size = math.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))
        return sum(x * b.get(t, 0) for t, x in a.items()) / size if size else 0

    short, full = [*NOTICES, *HEADERS], full_texts()
    every = {t for _, x in [*short, *full] for t in terms_of(x)}
    wide = lambda t: 1 + math.log((1 + n) / (1 + (df[t] if t in every else 0)))
    weighted = lambda terms: {t: c * wide(t) for t, c in Counter(terms).items()}

    def windows(text):
        """Nearest template over all windows of its length; notices and headers must name their licence."""
        if not ANCHOR.search(text):
            return (0, None)
        if spdx := spdx_licence(text):
            return (1.0, spdx)
        terms, best = terms_of(text), (0, None)
        for k, (licence, template) in enumerate([*short, *full]):
            *groups, never = NAMED[licence] if k < len(short) else ((),)
            own = weighted(terms_of(template))
            size = min(len(terms), len(terms_of(template)))
            for i in range(len(terms) - size + 1):
                window = terms[i : i + size]
                if all(set(g) & set(window) for g in groups) and not set(never) & set(window):
                    best = max(best, (round(cosine(weighted(window), own), 12), licence), key=lambda x: x[0])
        return best

    found = []
    for path, text in files:
        name = path.split("/")[-1].lower() if path else ""
        units = (text or "").split("\n") + ([text] if text and name.startswith("licen") else [])
        best = (0, None)
        for unit in units:
            for licence, notice in NOTICES:
                c = round(cosine(vector(unit), vector(notice)), 12)
                if c > best[0]:
                    best = (c, licence)
        best = max(best, windows(text or ""), key=lambda x: x[0])
        found.append(best[1] if best[0] >= threshold else None)
    given = {}
    for (path, _), own in sorted(zip(files, found), key=lambda x: (x[0][0] or "", str(x))):
        if path and own and path.split("/")[-1].lower().startswith("licen"):
            given.setdefault(path.rpartition("/")[0], own)
    out = []
    for (path, _), own in zip(files, found):
        licence, where = own, None
        if own is None and path:
            at = path.rpartition("/")[0]
            while at and at not in given:
                at = at.rpartition("/")[0]
            licence, where = given.get(at), at if at in given else None
        out.append((path, own, licence, where))
    return out


def test_matches_plain_version(spark):
    r = random.Random(4)
    words = "alpha beta the of under a license public version".split()
    files = []
    for i in range(120):
        folder = r.choice(["", "a", "a/b", "a/b/c", "d", "d/e"])
        lines = [" ".join(r.choices(words, k=r.randrange(1, 9))) for _ in range(r.randrange(1, 6))]
        if r.random() < 0.3:
            lines.insert(r.randrange(len(lines) + 1), r.choice(NOTICES)[1].upper() + r.choice(["", " Thanks to all."]))
        name = f"LICENSE-{i:03}" if r.random() < 0.1 else f"f{i:03}.txt"
        files.append((f"{folder}/{name}" if folder else name, "\n".join(lines)))
    files += [("d/e/tag.c", "// SPDX-License-Identifier: GPL-2.0-or-later\nalpha"), ("d/LICENSE", full_texts()[0][1])]
    files += [("a/b/head.c", HEADERS[1][1].replace(" of ", "\n// of ")), ("a/b/long.c", "alpha beta " * 20 + HEADERS[6][1])]
    files += [("a/x.txt", None), ("d/y.txt", ""), (None, "Released under the MIT License."), (None, "nothing")]
    df = spark.createDataFrame(files, "path string, text string").repartition(4)
    got = scan_licences(df).select("path", "own_licence", "licence", "licence_dir").collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute(files), key=str)
    assert any(row[1] for row in got) and any(row[3] for row in got)


def test_edge_cases(spark):
    rows = [("r/LICENSE", "Licensed under CC BY-NC 4.0.", 1)] * 2 + [("r/s/t/u.txt", "plain words " * 200_000, 2)]
    df = spark.createDataFrame(rows, "path string, text string, licence int")
    got = sorted((r.path, r.own_licence, r.licence, r.licence_dir) for r in scan_licences(df).collect() if r.own_licence)
    assert got == [("r/LICENSE", "CC-BY-NC-4.0", "CC-BY-NC-4.0", None)] * 2
    assert [(r.licence, r.licence_dir) for r in scan_licences(df).collect() if not r.own_licence] == [("CC-BY-NC-4.0", "r")]
    assert scan_licences(df.limit(0)).collect() == []
