"""Each stage of the pipeline against a plain version, on what the stage before kept."""

from pathlib import Path

import duckdb
import numpy as np
import pytest

pytest.importorskip("public_tokenizers")
import corpus_pipeline as pipeline  # noqa: E402
from test_jaccard import brute as brute_components  # noqa: E402
from test_langid import plain_phrases  # noqa: E402
from test_packing import check as check_packing  # noqa: E402
from test_spans import brute as brute_spans  # noqa: E402

from opinionlens.llm.langid import CrossParser, sample_languages  # noqa: E402
from opinionlens.llm.q_quality import quality_ctes  # noqa: E402
from opinionlens.session import materialize  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables")


def kept_ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_stages(spark):
    docs = materialize(spark.read.parquet(str(DATA / "documents.parquet")))
    names = [name for name, _ in pipeline.STAGES]
    assert names == ["quality rules", "language ID", "n-gram Jaccard join", "substring dedup", "packing"]
    stage = dict(pipeline.STAGES)

    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    good = sorted(r[0] for r in con.execute(f"WITH {quality_ctes()} SELECT doc_id FROM judged WHERE kept").fetchall())
    first = materialize(stage["quality rules"](spark, docs, str(DATA)))
    assert first.columns == docs.columns and kept_ids(first) == good and len(good) < docs.count()

    second = materialize(stage["language ID"](spark, first, str(DATA)))
    samples = sample_languages(first, F.lit(True))
    parser = CrossParser(samples.texts)
    expect = []
    for row in first.collect():
        phrases = np.array([plain_phrases(parser, row.text, t) for _, t in samples.texts])
        letters = np.count_nonzero(parser.encode(row.text))
        best = np.argmin(phrases * np.array(parser.weights))
        if letters and letters / phrases[best] >= pipeline.MIN_PHRASE_LETTERS:
            expect.append(row.doc_id)
    assert second.columns == docs.columns and kept_ids(second) == sorted(expect)

    third = materialize(stage["n-gram Jaccard join"](spark, second, str(DATA)))
    rows = [(r.doc_id, r.text) for r in second.collect()]
    components = brute_components(rows, n=pipeline.NEAR.n, percent=pipeline.NEAR.percent)
    assert third.columns == docs.columns
    assert kept_ids(third) == sorted(d for d, n, root in components if root == d or not n)

    fourth = materialize(stage["substring dedup"](spark, third, str(DATA)))
    rows = [(r.doc_id, r.text) for r in third.collect()]
    expect = sorted((d, t, len(t)) for d, t, _, gone in brute_spans(rows) if not gone or t.strip())
    assert fourth.columns == docs.columns
    assert sorted((r.doc_id, r.text, r.n_chars) for r in fourth.collect()) == expect

    pieces = stage["packing"](spark, fourth, str(DATA)).withColumn("ids", F.lit(None)).collect()
    check_packing(pieces, {r.doc_id: r.text for r in fourth.collect()}, 1024)


def test_planted_cases(spark):
    r = np.random.default_rng(8)
    common = "the of and to in a is that for it was with".split()
    words = common + ["".join(r.choice(list("etaoinshrdlu"), r.integers(3, 9))) for _ in range(400)]
    sentence = lambda: " ".join(r.choice(words, 9)).capitalize() + "."
    text = lambda n=20: " ".join(sentence() for _ in range(n))
    clean = {i: text() for i in range(12)}
    passage = " ".join(sentence() for _ in range(7))
    near = clean[3].split()
    near[40] = "changed"
    planted = {100: clean[2], 101: " ".join(near), 102: text() + "\n" + passage + "\n" + text(), 103: text() + "\n" + passage + "\n" + text()}
    planted |= {104: "too short", 105: " ".join(w + "$$$" for w in text().split()), 106: None, 107: "12 34 !! " * 100}
    rows = [(i, t, "en", "s", len(t or "")) for i, t in (clean | planted).items()]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for _, stage in pipeline.STAGES[:-1]:
        docs = materialize(stage(spark, docs, ""))
    got = {x.doc_id: x.text for x in docs.collect()}
    assert got.keys() == clean.keys() | {102, 103}
    assert all(got[i] == clean[i] for i in clean)
    assert passage in got[102] and passage not in got[103]
    empty = docs.limit(0)
    for _, stage in pipeline.STAGES:
        empty = stage(spark, empty, "")
    assert empty.collect() == []
