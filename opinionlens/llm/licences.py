"""Licence scans by sparse TF-IDF cosine, and inheritance from the nearest ancestor directory.

Every line of a file is a possible notice, and a licence file is compared as a
whole too. Full licence texts, headers and notices are also compared with all
windows of their own length in words, wherever lines end, and SPDX tags are read. Terms weigh by their inverse document frequency over all files; words
outside the templates weigh as unseen ones. A line can only reach the threshold
if it has one of the templates' key terms, so only lines with one are compared:
the terms left out make up too little of any template. A file without a licence of
its own inherits that of the nearest directory above it with a licence file.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinionlens.llm.common import text_slices, with_fields
from opinionlens.operators.scaling import bounded_join
from opinionlens.session import materialize

# Names of licences and the notices that announce them.
NOTICES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This program is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms are permitted under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms are permitted under the BSD 2-Clause License."),
    ("MPL-2.0", "This file is subject to the terms of the Mozilla Public License, version 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("ISC", "Released under the ISC License."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
# Standard headers, as they stand wrapped in comments, and notices with other words around them.
HEADERS = (
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    ("GPL-3.0", GPL_HEADER := "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", GPL_HEADER.replace("version 3", "version 2")),
    ("AGPL-3.0", GPL_HEADER.replace("GNU General", "GNU Affero General")),
    ("LGPL-3.0", GPL_HEADER.replace("GNU General", "GNU Lesser General")),
    ("LGPL-2.1", GPL_HEADER.replace("GNU General", "GNU Lesser General").replace("version 3", "version 2.1")),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Use of this source code is governed by an MIT-style license that can be found in the LICENSE file."),
    ("ISC", "Licensed under the ISC License."),
    ("GPL-3.0", "Licensed under the GNU General Public License v3.0."),
    ("GPL-2.0", "Licensed under the GNU General Public License v2.0."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
)
# Terms of which a window must hold one of each group, and terms it must not hold, to count as a notice or header.
NAMED = {
    "MIT": (("mit",), ()),
    "Apache-2.0": (("apache",), ()),
    "GPL-3.0": (("general",), ("3", "3.0"), ("lesser", "affero", "library")),
    "GPL-2.0": (("general",), ("2", "2.0"), ("lesser", "affero", "library")),
    "LGPL-3.0": (("lesser",), ("3", "3.0"), ()),
    "LGPL-2.1": (("lesser",), ("2.1",), ()),
    "AGPL-3.0": (("affero",), ()),
    "BSD-3-Clause": (("bsd",), ("3",), ()),
    "BSD-2-Clause": (("bsd",), ("2",), ()),
    "MPL-2.0": (("mozilla",), ()),
    "CC-BY-4.0": (("cc",), ("by",), ("4.0",), ("sa", "nc", "nd")),
    "CC-BY-SA-4.0": (("cc",), ("sa",), ("4.0",), ("nc", "nd")),
    "CC-BY-NC-4.0": (("cc",), ("nc",), ("4.0",), ("sa", "nd")),
    "ISC": (("isc",), ()),
    "Unlicense": (("unencumbered",), ()),
}
SPDX = re.compile(r"(?i)spdx-license-identifier:[ \t]*\(?[ \t]*([a-z0-9][a-z0-9.+-]*)")
# Each template has one of these.
ANCHOR = re.compile(r"(?i)licen[cs]|redistribut|permission|unencumbered|copyright")
LICENCE_FILE = r"(?i)(^|/)(licen[cs]e|copying|notice)[^/]*$"

_TERMS = re.compile(r"[a-z]+|[0-9]+(?:\.[0-9]+)*")


def terms_of(text: str) -> list[str]:
    return _TERMS.findall(text.lower())


def full_texts() -> list[tuple[str, str]]:
    """Whole licences; the AGPL is the GPL's text under its own name, which nearly all its clauses share."""
    found = {p.stem: p.read_text() for p in sorted((Path(__file__).parent / "licence_texts").glob("*.txt"))}
    found["AGPL-3.0"] = re.sub("(?i)gnu general public", "GNU Affero General Public", found["GPL-3.0"])
    return list(found.items())


def spdx_licence(text: str) -> str | None:
    """Licence of the first SPDX tag, without the suffixes that tell of later versions."""
    found = SPDX.search(text)
    if not found:
        return None
    own = re.sub(r"(?i)(-only|-or-later|\+)$", "", found[1].rstrip(".-"))
    return next((n for n in (*NAMED, "CC0-1.0") if n.lower() == own.lower()), own)


@dataclass
class Windows:
    """Templates that are compared with all windows of as many words as they have."""

    names: list[str]
    place: dict[str, int]
    weights: list[np.ndarray]
    lengths: list[int]
    short: int
    idf: np.ndarray

    @classmethod
    def of(cls, short: Sequence[tuple[str, str]], texts: Sequence[tuple[str, str]], files_with: dict[str, int], files: int) -> Windows:
        every = [*short, *texts]
        named = {t for groups in NAMED.values() for group in groups for t in group}
        place = {t: i for i, t in enumerate(sorted(named | {t for _, text in every for t in terms_of(text)}))}
        idf = np.array([1 + math.log((1 + files) / (1 + files_with.get(t, 0))) for t in place] + [1 + math.log(1 + files)])
        weights = []
        for _, text in every:
            own = np.zeros(len(idf))
            for term, n in Counter(terms_of(text)).items():
                own[place[term]] = n * idf[place[term]]
            weights.append(own / np.linalg.norm(own))
        return cls([n for n, _ in every], place, weights, [len(terms_of(x)) for _, x in every], len(short), idf)

    def best(self, text: str, threshold: float) -> tuple[str | None, float]:
        """The licence of the window nearest to its template, if it reaches ``threshold``, and the cosine."""
        if not ANCHOR.search(text):
            return None, 0.0
        if spdx := spdx_licence(text):
            return spdx, 1.0
        terms = terms_of(text)
        n, other = len(terms), len(self.place)
        ids = np.array([self.place.get(t, other) for t in terms], np.int64)
        held = lambda values, size: (sums := np.concatenate([[0], np.cumsum(values)]))[size:] - sums[:-size]
        best: tuple[str | None, float] = (None, 0.0)
        present = set(terms)
        for k, (name, own, length) in enumerate(zip(self.names, self.weights, self.lengths, strict=True)):
            *groups, never = NAMED.get(name, ((),)) if k < self.short else ((),)
            if not n or not all(present.intersection(g) for g in groups):
                continue
            size = min(n, length)
            dots = held((own * self.idf)[ids], size)
            # Repeated words only lengthen a window's vector, so this is no less than its cosine.
            bound = dots / np.sqrt(held(self.idf[ids] ** 2, size))
            for group in groups:
                bound[held(np.isin(ids, [self.place[t] for t in group]), size) == 0] = 0
            bound[held(np.isin(ids, [self.place[t] for t in never]), size) > 0] = 0
            at = np.flatnonzero(bound >= max(threshold, best[1]) - 1e-9)
            for i in at[np.argsort(-bound[at], kind="stable")]:
                if bound[i] <= best[1]:
                    break
                counts = Counter(terms[i : i + size])
                norm = math.sqrt(sum((c * self.idf[self.place.get(t, other)]) ** 2 for t, c in counts.items()))
                cosine = min(1.0, float(dots[i]) / norm)
                if cosine >= threshold and cosine > best[1]:
                    best = name, cosine
        return best


@dataclass
class Templates:
    """Template vectors in TF-IDF weights, and the terms by which lines are found."""

    names: list[str]
    place: dict[str, int]
    weights: np.ndarray
    idf: np.ndarray
    unseen: float
    keys: re.Pattern

    @classmethod
    def of(cls, notices: Sequence[tuple[str, str]], files_with: dict[str, int], files: int, threshold: float) -> Templates:
        place = {t: i for i, t in enumerate(sorted({t for _, text in notices for t in terms_of(text)}))}
        idf = np.array([1 + math.log((1 + files) / (1 + files_with.get(t, 0))) for t in place])
        weights = np.zeros((len(notices), len(place)))
        for row, (_, text) in enumerate(notices):
            for term, n in Counter(terms_of(text)).items():
                weights[row, place[term]] = n * idf[place[term]]
        weights /= np.linalg.norm(weights, axis=1, keepdims=True)
        left = np.ones(len(place), bool)
        keys = []
        for term in sorted(place, key=lambda t: (-idf[place[t]], t)):
            if (np.linalg.norm(weights[:, left], axis=1) < threshold).all():
                break
            keys.append(term)
            left[place[term]] = False
        pattern = "|".join(re.escape(k) for k in sorted(keys, key=lambda k: (-len(k), k)))
        return cls([n for n, _ in notices], place, weights, idf, 1 + math.log(1 + files), re.compile(rf"(?<![a-z])(?:{pattern})(?![a-z])"))

    def best(self, text: str) -> tuple[str | None, float]:
        """The nearest template's licence (the first of equals) and the cosine to it."""
        own = np.zeros(len(self.place))
        rest = 0.0
        for term, n in Counter(terms_of(text)).items():
            if term in self.place:
                own[self.place[term]] = n * self.idf[self.place[term]]
            else:
                rest += (n * self.unseen) ** 2
        size = math.sqrt((own**2).sum() + rest)
        if not size:
            return None, 0.0
        cosines = self.weights @ own / size
        at = int(np.argmax(np.round(cosines, 12)))
        return self.names[at], float(cosines[at])

    def scan(self, text: str, whole: bool) -> tuple[str | None, float]:
        """Best licence among the lines of a text and, with ``whole``, the text."""
        lower = text.lower()
        lines: dict[str, None] = {}
        end = 0
        for found in self.keys.finditer(lower):
            if found.start() < end:
                continue
            start = lower.rfind("\n", 0, found.start()) + 1
            end = lower.find("\n", found.start())
            end = len(lower) if end < 0 else end
            lines[lower[start:end]] = None
        best: tuple[str | None, float] = (None, 0.0)
        for unit in [*lines, *([lower] if whole and lines else [])]:
            one = self.best(unit)
            best = max(best, one, key=lambda x: x[1])
        return best


def document_frequencies(files: DataFrame, terms: Sequence[str], text: str = "text") -> tuple[dict[str, int], int]:
    """Files that each of ``terms`` occurs in, and the number of files; one row per term reaches the driver."""
    wanted = frozenset(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            counts[""] += batch.num_rows
            for _, texts in text_slices(batch, text):
                for one in texts.to_pylist():
                    counts.update(wanted.intersection(terms_of(one)))
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["term", "n"])

    counted = files.select(text).mapInArrow(run, "term string, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    found = {r.term: r.n for r in counted.collect()}
    return found, found.pop("", 0)


def own_licences(files: DataFrame, templates: Templates, windows: Windows, threshold: float, text: str, path: str) -> DataFrame:
    """Replace the text by ``own_licence`` (null under the threshold) and ``similarity``."""
    names = [c for c in files.columns if c not in (text, "own_licence", "similarity", "__whole")]
    schema = with_fields(files.select(*names).schema, own_licence="string", similarity="double")
    # Plain fields: broadcasts are pickled by reference to their classes, which workers may not be able to import.
    shared = files.sparkSession.sparkContext.broadcast((tuple(vars(templates).values()), tuple(vars(windows).values())))
    marked = files.select(text, *names, F.coalesce(F.col(path).rlike(LICENCE_FILE), F.lit(False)).alias("__whole"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, windows = Templates(*shared.value[0]), Windows(*shared.value[1])
        for whole in batches:
            for batch, texts in text_slices(whole, text):
                found = []
                for t, w in zip(texts.to_pylist(), batch["__whole"].to_pylist(), strict=True):
                    found.append(max(own.scan(t, w), windows.best(t, threshold), key=lambda x: x[1]))
                licences = pa.array([n if s >= threshold else None for n, s in found], pa.string())
                columns = [*(batch[c] for c in names), licences, pa.array([s for _, s in found], pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, names=[*names, "own_licence", "similarity"])

    return marked.mapInArrow(run, schema)


def scan_licences(
    files: DataFrame,
    notices: Sequence[tuple[str, str]] = NOTICES,
    threshold: float = 0.7,
    path: str = "path",
    text: str = "text",
) -> DataFrame:
    """Add own_licence, similarity, licence and licence_dir to every row, without its text.

    ``licence`` is the own licence or, without one, that of the nearest
    directory at or above the file's that has a licence file with a licence
    (``licence_dir``; null if the licence is the file's own). Of several licence
    files in a directory the one with the smallest path counts. Null and empty
    texts have no licence of their own; a null path inherits nothing. Repeated
    rows are each scanned; an empty table gives an empty one. Columns of
    ``files`` named like an added one are replaced; names with two leading
    underscores are the operator's own.
    """
    short, texts = [*notices, *HEADERS], full_texts()
    counted = document_frequencies(files, sorted({t for _, n in [*short, *texts] for t in terms_of(n)}), text)
    templates = Templates.of(notices, *counted, threshold)
    windows = Windows.of(short, texts, *counted)
    kept = files.select(*[c for c in files.columns if c not in ("licence", "licence_dir")])
    scanned = materialize(own_licences(kept, templates, windows, threshold, text, path).withColumn("__dir", F.regexp_extract(path, "^(.*)/[^/]*$", 1)))
    given = (
        scanned.filter(F.col(path).rlike(LICENCE_FILE) & F.col("own_licence").isNotNull())
        .groupBy(F.col("__dir").alias("__above"))
        .agg(F.min_by("own_licence", path).alias("__licence"))
    )
    steps = F.split("__dir", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(steps)), lambda n: F.array_join(F.slice(steps, F.lit(1), n), "/"))
    dirs = scanned.select("__dir").filter(F.col("__dir").isNotNull()).distinct()
    ways = dirs.select("__dir", F.explode(F.array_union(above, F.array(F.lit("")))).alias("__above"))
    depth = F.struct(F.char_length("__above").alias("d"), F.col("__above").alias("above"), F.col("__licence").alias("licence"))
    nearest = materialize(ways.join(given, "__above").groupBy("__dir").agg(F.max(depth).alias("__best")))
    joined = bounded_join(scanned, nearest, "__dir", path)
    inherits = F.col("own_licence").isNull()
    return joined.select(
        *[c for c in scanned.columns if c != "__dir"],
        F.coalesce("own_licence", F.col("__best.licence")).alias("licence"),
        F.when(inherits, F.col("__best.above")).alias("licence_dir"),
    )
