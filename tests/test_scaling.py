import random

import pytest
from pyspark.sql import functions as F

from opinionlens import session
from opinionlens.operators.scaling import bounded_join, lookup_join, with_position
from opinionlens.session import CHECKPOINT_KEY, materialize, shared_dir


def skewed(spark, n=3000):
    rnd = random.Random(5)
    rows = [(i, "hot" if rnd.random() < 0.4 else rnd.choice(["a", "b", "c", "d", None])) for i in range(n)]
    return spark.createDataFrame(rows, "id long, k string"), rows


def test_positions_are_global_and_dense(spark):
    df, rows = skewed(spark)
    got = with_position(df.filter("k is not null"), ["k", "id"]).orderBy("position").collect()
    expect = sorted((k, i) for i, k in rows if k is not None)
    assert [(r["k"], r["id"]) for r in got] == expect
    assert [r["position"] for r in got] == list(range(len(expect)))


def test_lookup_join_equals_left_join(spark):
    df, rows = skewed(spark)
    small = spark.createDataFrame([("hot", 1), ("a", 2), ("zz", 3)], "k string, v int")
    expect = sorted((i, k or "", {"hot": 1, "a": 2}.get(k, -1)) for i, k in rows)
    for joined in (lookup_join(df, small, "k", "id", share=0.3), bounded_join(df, small, "k", "id"),
                   bounded_join(df, small, "k", "id", max_rows=0)):
        got = joined.select("id", F.coalesce("k", F.lit("")), F.coalesce("v", F.lit(-1))).collect()
        assert sorted(map(tuple, got)) == expect


def test_lookup_join_hot_key_without_match(spark):
    df, rows = skewed(spark)
    small = spark.createDataFrame([("a", 2)], "k string, v int")
    got = lookup_join(df, small, "k", "id", share=0.3)
    assert got.filter("k = 'hot' and v is not null").count() == 0
    assert got.count() == len(rows)


class Conf:
    def __init__(self, path):
        self.path = path

    def get(self, key, default=None):
        return self.path if key == CHECKPOINT_KEY else default


class Session:
    """Stands in for a session whose setting cannot be changed at run time."""

    def __init__(self, path, master):
        self.conf = Conf(path)
        self.sparkContext = type("Context", (), {"master": master, "applicationId": f"app-{master}"})


def test_shared_dir_follows_the_session(spark):
    assert shared_dir(Session("hdfs:///shared", "yarn")) == "hdfs:///shared"
    local = Session(None, "local[2]")
    assert shared_dir(local) == shared_dir(local)
    for master in ("yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError):
            shared_dir(Session(None, master))
    assert materialize(spark.range(5)).count() == 5


def test_spread_before_a_join_follows_the_size_of_many_files(spark, tmp_path, monkeypatch):
    path, cores = str(tmp_path / "many"), spark.sparkContext.defaultParallelism
    spark.range(2000).repartition(cores + 1).write.parquet(path)
    monkeypatch.setattr(session, "SPREAD_BYTES", 100)
    df = spark.read.parquet(path)
    assert session.spread(df, "id") is df
    dealt = session.spread(df, "id", joined=True)
    parts = dealt.rdd.getNumPartitions()
    assert parts > int(spark.conf.get("spark.sql.shuffle.partitions")) and sorted(r[0] for r in dealt.collect()) == list(range(2000))
    monkeypatch.setattr(session, "SPREAD_BYTES", 50)
    assert session.spread(df, "id", joined=True).rdd.getNumPartitions() > parts
