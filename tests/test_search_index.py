"""Indexed search against scans of the same rows."""

import json
import os
import random
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from opinionlens.operators import search_index
from opinionlens.operators.explore import hits
from opinionlens.operators.search_index import SearchIndex, _ranges, keyword_grams

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCHEMA = "id bigint, doc_id bigint, text string, keyword1 string, keyword2 string, keyword3 string, dominant_topic int"
KEYWORDS = ["ABC", "abcab", "É x", "a%cab", "a_c", "ab", "", "%", "back\\s", "不医改", "医改 工", "zzz", "abca%bcc", "_ _b", "𝄞𝄞𝄞", "gone"]


def rows_of(seed, first, n):
    r = random.Random(seed)
    word = lambda: "".join(r.choices("aAbBc É%_\\不医改工资𝄞", k=r.randrange(0, 12)))
    maybe = lambda x: None if r.random() < 0.1 else x
    out = [(first + i, 10 * (first + i), maybe(word() * r.randrange(1, 4)), maybe(word()), maybe(word()), None, i % 3) for i in range(n)]
    return [*out, (first + n, 10 * (first + n), "back\\slash", None, None, "gone", 0)]


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    rows = rows_of(1, 1, 400) + rows_of(2, 5000, 300)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    index = SearchIndex(spark, str(tmp_path_factory.mktemp("index")), block_ids=128)
    index.add(df.filter("id < 300"))
    index.add(df.filter("id >= 300"))  # shares a block with the first load
    return df, index


def ids(df):
    return sorted(r["id"] for r in df.collect())


@pytest.mark.parametrize("literal, named", [(False, search_index.NAMED_IDS), (True, 0)])
def test_same_rows_as_a_scan(built, monkeypatch, literal, named):
    df, index = built
    monkeypatch.setattr(search_index, "NAMED_IDS", named)
    for keyword in KEYWORDS:
        assert ids(hits(index.rows_for(keyword, literal), keyword, literal)) == ids(hits(df, keyword, literal)), keyword


def test_append_indexes_new_rows_once(spark, tmp_path):
    index = SearchIndex(spark, str(tmp_path / "index"), block_ids=64)
    index.add(spark.createDataFrame(rows_of(3, 1, 100), SCHEMA))
    batch = spark.createDataFrame(rows_of(4, 50, 120), SCHEMA).drop("id")
    for _ in range(2):  # the second load adds nothing
        index.append(batch)
        rows = index.rows().collect()
        assert sorted(r["id"] for r in rows) == list(range(1, len({r["doc_id"] for r in rows}) + 1))
    assert len(rows) == 170
    assert ids(hits(index.rows_for("abc"), "abc")) == ids(hits(index.rows(), "abc"))
    with pytest.raises(ValueError):
        index.add(spark.createDataFrame([(None, 1, "x", None, None, None, 0)], SCHEMA))


def test_grams_and_ranges():
    assert keyword_grams(" ABcd ") == ["abc", "bcd"] and keyword_grams("ab%cd_efg") == ["efg"]
    assert keyword_grams("ab%c", literal=True) == ["ab%", "b%c"] and keyword_grams("ab") == []
    many = sorted(random.Random(1).sample(range(10**6), 5000))
    ranges = _ranges(many)
    assert len(ranges) <= search_index.ID_RANGES and all(any(a <= i <= b for a, b in ranges) for i in many)
    assert _ranges([4]) == [(4, 4)] and _ranges([4, 5, 6]) == [(4, 6)]


MEASURE = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession, functions as F
from opinionlens.operators.explore import hits
from opinionlens.operators.search_index import SearchIndex
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
  .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", "file://" + sys.argv[2]).config("spark.eventLog.rolling.enabled", "false")
  .config("spark.eventLog.compress", "false").getOrCreate())
rows = spark.range(1, 100001).select("id", F.concat(F.lit("common text "), F.sha2(F.col("id").cast("string"), 256)).alias("text"),
  *[F.lit(None).cast("string").alias(f"keyword{i}") for i in (1, 2, 3)])
rows = rows.withColumn("text", F.when(F.col("id").isin(5, 70000, 70001), F.concat("text", F.lit(" needle"))).otherwise(F.col("text")))
index = SearchIndex(spark, sys.argv[2] + "/index")
index.add(rows)
spark.sparkContext.setJobDescription("search")
print(sorted(r["id"] for r in hits(index.rows_for("needle"), "needle").collect()))
spark.stop()
"""


def test_rows_read_follow_the_candidates(tmp_path):
    """By Spark's event log: of 100,000 rows and 5 million gram entries a search reads a few pages."""
    done = subprocess.run([sys.executable, "-c", MEASURE, ROOT, str(tmp_path)], capture_output=True, text=True, timeout=300)
    assert done.stdout.strip() == "[5, 70000, 70001]", done.stderr[-2000:]
    log = next(p for p in tmp_path.iterdir() if p.is_file() and p.name.startswith(("local-", "app-")))
    wanted, read = set(), 0
    for line in log.read_text().splitlines():
        event = json.loads(line)
        if event["Event"] == "SparkListenerJobStart" and event["Properties"].get("spark.job.description") == "search":
            wanted.update(event["Stage IDs"])
        if event["Event"] == "SparkListenerTaskEnd" and event["Stage ID"] in wanted:
            read += event["Task Metrics"]["Input Metrics"]["Records Read"]
    assert 3 <= read <= 10_000


def test_lists_leave_tasks_packed(spark):
    """A gram is one row for each slice of a task, not one for each row that holds it; long and blank rows too."""
    rows = [(i, 0 if i < 700 else 1, i % 700, "ABCD " + "é" * (i % 5), None) for i in range(1000)] + [(2000, 2, 5, "xyz" * 900_000, "aBc"), (2001, 2, 6, "", None)]
    df = spark.createDataFrame(rows, "id bigint, block bigint, offset int, a string, b string").repartition(1)
    lists = search_index._lists_of(df, ["a", "b"])
    found = {}
    for r in lists.collect():
        found.setdefault((r["gram"], r["block"]), []).append(sorted(r["offsets"]))
        assert r["offsets"] == sorted(set(r["offsets"]))
    assert lists.count() < 30
    assert sorted(x for own in found["abc", 0] for x in own) == list(range(700)) and found["abc", 2] == [[5]]
    assert sorted(x for own in found["ééé", 1] for x in own) == [i for i in range(300) if i % 5 > 2]
    assert {g for g, b in found if b == 2} == {"xyz", "yzx", "zxy", "abc"}


def test_add_of_stored_rows_writes_no_second_copy(spark, tmp_path, monkeypatch):
    rows_path = str(tmp_path / "rows")
    spark.createDataFrame(rows_of(6, 1, 50), SCHEMA).write.parquet(rows_path)
    copies = []
    monkeypatch.setattr(search_index, "materialize", lambda df: copies.append(df) or df)
    index = SearchIndex(spark, str(tmp_path / "index"), block_ids=16)
    index.add(spark.read.parquet(rows_path), stored=True)
    assert not copies and index.rows().count() == 51
    assert ids(hits(index.rows_for("abc"), "abc")) == ids(hits(index.rows(), "abc"))
