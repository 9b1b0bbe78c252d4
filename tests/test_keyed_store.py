import threading

import pytest
from pyspark.sql import functions as F

from opinionlens.operators import marks
from opinionlens.operators.keyed_store import KeyedStore


def _batch(spark, keys, value="a"):
    return spark.createDataFrame([(k, f"{value}{k}", k % 3 if k % 5 else None) for k in keys], "doc_id long, text string, topic int")


def _stored(store):
    return sorted((r["id"], r["doc_id"], r["text"], r["topic"]) for r in store.rows().collect())


def test_mark_has_one_writer(spark, tmp_path):
    path = f"{tmp_path}/marks/1"
    won = []
    tries = [threading.Thread(target=lambda i=i: won.append((marks.put_once(spark, path, str(i)), i))) for i in range(8)]
    [t.start() for t in tries]
    [t.join() for t in tries]
    first = [i for ok, i in won if ok]
    assert len(first) == 1
    assert [r[0] for r in marks.texts(spark, f"{tmp_path}/marks").collect()] == [str(first[0])]
    assert marks.texts(spark, f"{tmp_path}/none").count() == 0


def test_mark_by_rename(spark, tmp_path):
    path = f"{tmp_path}/marks/1"
    assert marks._rename(spark, path, "é {1}")
    assert not marks._rename(spark, path, "second")
    assert [r[0] for r in marks.texts(spark, f"{tmp_path}/marks").collect()] == ["é {1}"]


def test_loads_number_new_keys(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path), buckets=8, partition_by="topic")
    assert store.append(_batch(spark, [5, 3, 9, 3])) == 3
    assert store.append(_batch(spark, [5, 3, 9])) == 0
    assert store.append(_batch(spark, [9, 4, 10], "b")) == 2
    assert store.append(_batch(spark, [])) == 0
    want = [(1, 3, "a3", 0), (2, 5, "a5", None), (3, 9, "a9", 0), (4, 4, "b4", 1), (5, 10, "b10", None)]
    assert _stored(store) == want
    assert store.rows().columns == ["id", "doc_id", "text", "topic"]


def test_null_keys_and_other_columns_are_refused(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path))
    with pytest.raises(ValueError):
        store.rows()
    with pytest.raises(ValueError):
        store.append(spark.createDataFrame([(None, "x")], "doc_id long, text string"))
    store.append(_batch(spark, [1]))
    with pytest.raises(ValueError):
        store.append(_batch(spark, [2]).drop("text"))


def test_load_reads_only_buckets_it_hits(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path), buckets=16)
    store.append(_batch(spark, range(400)))
    keys = store._table("keys", store._log(), spark.read.parquet(f"{tmp_path}/keys").drop("__load").schema)
    one = keys.filter(F.col("__bucket").isin([3]))
    assert {f.rsplit("/", 2)[1] for f in (r[0] for r in one.select(F.input_file_name()).distinct().collect())} == {"__bucket=3"}


def test_load_that_loses_the_mark(spark, tmp_path, monkeypatch):
    """Another load commits between this one's look at the keys and its own mark."""
    mine, other = KeyedStore(spark, str(tmp_path), buckets=4), KeyedStore(spark, str(tmp_path), buckets=4)
    mine.append(_batch(spark, [1]))
    for keys, added in (([11, 12], 3), ([20, 21, 22], 0), ([40, 41], 2)):
        theirs = {(11, 12): [2, 3], (20, 21, 22): [20, 21, 22], (40, 41): [40]}[tuple(keys)]
        pending = [theirs]
        write = KeyedStore._write

        def late(self, *args, pending=pending, write=write):
            if pending and self is mine:
                other.append(_batch(spark, pending.pop(), "o"))
            write(self, *args)

        monkeypatch.setattr(KeyedStore, "_write", late)
        n = mine.append(_batch(spark, keys, "m"))
        monkeypatch.setattr(KeyedStore, "_write", write)
        assert n == len(set(keys) - set(theirs))
    rows = _stored(mine)
    assert [r[1] for r in sorted(rows, key=lambda r: r[1])] == [1, 2, 3, 11, 12, 20, 21, 22, 40, 41]
    assert len({r[0] for r in rows}) == len(rows)
    assert {r[2] for r in rows} == {"a1", "o2", "o3", "m11", "m12", "o20", "o21", "o22", "o40", "m41"}


def test_loads_side_by_side(spark, tmp_path):
    """Loads that overlap in time and keys: each key once, ids disjoint."""
    store = KeyedStore(spark, str(tmp_path), buckets=4)
    added = []
    loads = [range(0, 60), range(40, 100), range(90, 130)]
    threads = [threading.Thread(target=lambda k=k: added.append(store.append(_batch(spark, k)))) for k in loads]
    [t.start() for t in threads]
    [t.join() for t in threads]
    rows = _stored(store)
    assert sorted(r[1] for r in rows) == list(range(130))
    assert len({r[0] for r in rows}) == 130 and sum(added) == 130
