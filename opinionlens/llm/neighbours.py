"""Approximate nearest neighbours: NN-descent in Spark, greedy search on its graph.

Equal vectors are one node. The graph starts from random hyperplane groups. In
each round a node's neighbours, reverse neighbours and itself meet in one small
group, are compared with one another, and each keeps the best it has met. Searches
walk the graph from the query's own neighbours, a few nodes a step, as Spark
joins of all queries at once. The graph is built on unit vectors of half
precision; the answers are scored on the original vectors in double precision.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinionlens.session import materialize


@dataclass(frozen=True)
class GraphSettings:
    """Figures of NN-descent and of the search; recall against brute force is measured in the tests."""

    neighbours: int = 24
    #: Reverse neighbours, nearest first, that meet in a node's group. (NN-descent samples them;
    #: the others still meet the node in the groups of its own neighbours.)
    reverse: int = 16
    #: Rounds at most; they end when the mean score of the neighbours rises by less than ``gain``.
    rounds: int = 12
    gain: float = 0.0005
    #: What each member of a group takes from it.
    kept: int = 8
    tables: int = 12
    group: int = 96
    beam: int = 192
    expand: int = 64
    steps: int = 4
    seed: int = 7


def usable(vector: str) -> Column:
    """Not null or empty, without null or non-finite components, and not zero."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return F.coalesce((F.size(vector) > 0) & F.forall(vector, fine) & F.exists(vector, lambda x: x != 0), F.lit(False))


def _with_code(nodes: DataFrame) -> DataFrame:
    """Add ``code``, the unit vector in half precision, as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = batch["vector"].flatten().to_numpy().reshape(batch.num_rows, -1)
            unit = vectors / np.abs(vectors).max(axis=1, keepdims=True)
            unit = (unit / np.linalg.norm(unit, axis=1, keepdims=True)).astype(np.float16)
            yield pa.RecordBatch.from_arrays([batch["node"], pa.array([u.tobytes() for u in unit], pa.binary())], names=["node", "code"])

    return nodes.select("node", "vector").mapInArrow(run, "node bigint, code binary")


def _codes(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float16).reshape(len(column), -1).astype(np.float32)


def _first_groups(codes: DataFrame, settings: GraphSettings) -> DataFrame:
    """(grp, node, code): each node in ``tables`` groups of nodes on the same side of random hyperplanes."""
    n = codes.count()
    bits = max(0, math.ceil(math.log2(max(n, 1) / settings.group)))
    tables, seed = settings.tables, settings.seed

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            unit = _codes(batch["code"])
            planes = np.random.default_rng(seed).normal(size=(tables, unit.shape[1], bits)).astype(np.float32)
            for t in range(tables):
                side = (unit @ planes[t] > 0).astype(np.int64) @ (1 << np.arange(bits, dtype=np.int64)) if bits else np.zeros(len(unit), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(side * tables + t), batch["node"], batch["code"]], names=["grp", "node", "code"])

    sided = materialize(codes.mapInArrow(run, "grp bigint, node bigint, code binary"))
    # Large groups are dealt out at random into parts of the intended size.
    parts = sided.groupBy("grp").agg(F.ceil(F.count("*") / settings.group).alias("parts"))
    dealt = sided.join(parts, "grp")
    return dealt.select(F.xxhash64("grp", F.pmod(F.xxhash64("node", F.lit(seed)), "parts")).alias("grp"), "node", "code")


def _meet(groups: DataFrame, kept: int) -> DataFrame:
    """(u, v, score): for each member of each group the ``kept`` nearest others in it."""

    def pairs(nodes: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        near = codes @ codes.T
        near[nodes[:, None] == nodes] = -np.inf
        k = min(kept, len(nodes) - 1)
        best = np.argpartition(-near, k - 1, axis=1)[:, :k]
        scores = np.take_along_axis(near, best, axis=1).ravel()
        u, v = np.repeat(nodes, k), nodes[best].ravel()
        fine = np.isfinite(scores)
        return u[fine], v[fine], scores[fine]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, nodes, codes = np.zeros(0, np.int64), np.zeros(0, np.int64), None
        ended = False
        while not ended:
            batch = next(batches, None)
            ended = batch is None
            if not ended and batch.num_rows:
                new = _codes(batch["code"])
                key = np.append(key, batch["grp"].to_numpy())
                nodes = np.append(nodes, batch["node"].to_numpy())
                codes = new if codes is None else np.concatenate([codes, new])
            if not len(key):
                continue
            bounds = np.append(np.flatnonzero(np.append(True, key[1:] != key[:-1])), len(key))
            whole = len(bounds) - 1 - (not ended)  # the last group may go on
            found = [pairs(nodes[a:b], codes[a:b]) for a, b in zip(bounds[:whole], bounds[1:]) if b - a > 1]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found)], names=["u", "v", "score"])
            key, nodes, codes = key[bounds[whole] :], nodes[bounds[whole] :], codes[bounds[whole] :]

    ready = groups.repartition("grp").sortWithinPartitions("grp", "node").select("grp", "node", "code")
    return ready.mapInArrow(run, "u bigint, v bigint, score float")


def _best(edges: DataFrame, k: int) -> DataFrame:
    """The ``k`` best distinct neighbours of each node."""
    order = Window.partitionBy("u").orderBy(F.desc("score"), "v")
    merged = edges.groupBy("u", "v").agg(F.max("score").alias("score"))
    return merged.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).drop("rank")


def nn_descent(codes: DataFrame, settings: GraphSettings) -> DataFrame:
    """(u, v, score): the approximate neighbour graph."""
    graph = materialize(_best(_meet(_first_groups(codes, settings), settings.neighbours), settings.neighbours))
    before = -1.0
    for _ in range(settings.rounds):
        mean = graph.agg(F.avg("score")).first()[0]
        if mean is None or mean - before < settings.gain:
            break
        before = mean
        nearest = Window.partitionBy("v").orderBy(F.desc("score"), "u")
        back = graph.withColumn("rank", F.row_number().over(nearest)).filter(F.col("rank") <= settings.reverse)
        members = (
            graph.select(F.col("u").alias("grp"), F.col("v").alias("node"))
            .union(back.select(F.col("v").alias("grp"), F.col("u").alias("node")))
            .union(codes.select(F.col("node").alias("grp"), "node"))
            .distinct()
        )
        met = _meet(members.join(codes, "node"), settings.kept)
        graph = materialize(_best(graph.union(met), settings.neighbours))
    return graph


def _score(pairs: DataFrame, codes: DataFrame) -> DataFrame:
    """(q, v, score) of pairs (q, v) of nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                near = np.einsum("ij,ij->i", _codes(batch["a"]), _codes(batch["b"]))
                yield pa.RecordBatch.from_arrays([batch["q"], batch["v"], pa.array(near)], names=["q", "v", "score"])

    own = codes.select(F.col("node").alias("q"), F.col("code").alias("a"))
    other = codes.select(F.col("node").alias("v"), F.col("code").alias("b"))
    joined = pairs.join(own, "q").join(other, "v").select("q", "v", "a", "b")
    return joined.mapInArrow(run, "q bigint, v bigint, score float")


def greedy_search(queries: DataFrame, graph: DataFrame, codes: DataFrame, settings: GraphSettings) -> DataFrame:
    """(q, v, score): the ``beam`` best nodes found for each query node (column q), itself left out.

    Each step opens the ``expand`` best nodes of each query's beam that are not
    open yet, and compares the query with their neighbours in either direction.
    """
    nearest = Window.partitionBy("v").orderBy(F.desc("score"), "u")
    back = graph.withColumn("rank", F.row_number().over(nearest)).filter(F.col("rank") <= settings.neighbours)
    ways = materialize(graph.select("u", "v").union(back.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct())
    order = Window.partitionBy("q").orderBy(F.desc("score"), "v")
    start = queries.join(ways, queries["q"] == ways["u"]).select("q", "v")
    beam = materialize(_score(start, codes).withColumn("open", F.lit(False)))
    for _ in range(settings.steps):
        ranked = beam.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= settings.beam)
        closed = Window.partitionBy("q", "open").orderBy("rank")
        chosen = ~F.col("open") & (F.row_number().over(closed) <= settings.expand)
        marked = materialize(ranked.withColumn("now", chosen).select("q", "v", "score", "open", "now"))
        reached = marked.filter("now").select("q", F.col("v").alias("u")).join(ways, "u").select("q", "v").distinct().filter("q <> v")
        fresh = reached.join(marked.select("q", "v"), ["q", "v"], "left_anti")
        known = marked.select("q", "v", "score", (F.col("open") | F.col("now")).alias("open"))
        beam = materialize(known.union(_score(fresh, codes).withColumn("open", F.lit(False))))
    return beam.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= settings.beam).select("q", "v", "score")


def nearest_neighbours(
    vectors: DataFrame,
    is_query: Callable[[Column], Column],
    k: int = 5,
    id: str = "vec_id",
    vector: str = "embedding",
    settings: GraphSettings | None = None,
) -> DataFrame:
    """(query_id, rank, <id>, score): the ``k`` nearest found of each query row by cosine, itself left out.

    ``is_query`` makes a condition of the id column. Null, empty and zero vectors, those
    with null or non-finite components, rows without an id, and vectors of
    another length than most have take no part. Of rows with one id the smallest
    vector counts. Ties go to the smaller id. With fewer rows than ``k``, all are
    returned; an empty table gives an empty result.
    """
    settings = settings or GraphSettings()
    spark = vectors.sparkSession
    clean = vectors.select(F.col(id).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    clean = clean.filter(F.col("id").isNotNull() & usable("vector")).groupBy("id").agg(F.min("vector").alias("vector"))
    clean = materialize(clean)
    lengths = clean.groupBy(F.size("vector").alias("n")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), "n").first()
    kind = f"query_id bigint, rank int, {id} bigint, score double"
    if lengths is None:
        return spark.createDataFrame([], kind)
    clean = clean.filter(F.size("vector") == lengths["n"])
    # Of equal vectors the first k + 1 ids are enough for any query; the smallest names the node.
    same = Window.partitionBy("vector").orderBy("id")
    member = materialize(
        clean.withColumn("node", F.min("id").over(Window.partitionBy("vector"))).withColumn("place", F.row_number().over(same))
    ).select("id", "node", "place", "vector")
    nodes = member.filter("place = 1").select("node", "vector")
    codes = materialize(_with_code(nodes))
    asked = member.filter(is_query(F.col("id"))).select(F.col("id").alias("query_id"), F.col("node").alias("q"))
    graph = nn_descent(codes, settings)
    found = greedy_search(asked.select("q").distinct(), graph, codes, settings).select("q", F.col("v").alias("node"))
    found = found.union(asked.select("q", F.col("q").alias("node")).distinct())
    short = member.filter(F.col("place") <= k + 1).select("node", "id", "vector")
    query_vectors = member.select(F.col("id").alias("query_id"), F.col("vector").alias("query_vector"))
    pairs = asked.join(found, "q").join(short, "node").filter("id <> query_id").join(query_vectors, "query_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (batch[c].flatten().to_numpy().reshape(batch.num_rows, -1) for c in ("query_vector", "vector"))
            cosine = (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))
            yield pa.RecordBatch.from_arrays([batch["query_id"], batch["id"], pa.array(cosine)], names=["query_id", "id", "score"])

    scored = pairs.select("query_id", "id", "query_vector", "vector").mapInArrow(run, "query_id bigint, id bigint, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    ranked = scored.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id), "score")
