"""Nearest neighbours by inner product: probed lists, scanned adaptively.

A vector is extended by one component to the largest length, so that the largest
inner product is the smallest distance, and dealt to the list of its nearest
centroid. A query probes the lists nearest to it. Within each list, vectors are
rotated and scanned in blocks of columns: after each block a hypothesis test on the
partial distance abandons candidates that are unlikely to reach the best found so
far. What is left is scored in double precision on the original vectors.

Centroids and the number of probed lists are fitted on a bounded sample; every row is
indexed. Lists are cut into chunks and queries into blocks, so that a task holds a
bounded number of either, however many vectors are alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tricycle.plans import materialize

NEAREST = 20
SAMPLE = 32_768  # rows that centroids and probes are fitted on
SAMPLE_QUERIES = 256
LISTS = 4_096  # at most
LIST_ROWS = 1_024  # of a list, on average, while the number of lists allows
RECALL = 0.96  # of the sample's neighbours, that the probed lists hold
CHUNK = 4_096  # vectors of a list, or queries that probe it, in one task
COLUMNS = 16  # of a block
HEAD = 256  # vectors of a list that are compared in full, for the bound
QUERIES = 64  # that are compared with a list at a time
SIGNIFICANCE = 2.1  # standard deviations of the test


@dataclass
class Index:
    """Centroids and rotation of vectors with ``dimension`` components."""

    dimension: int
    longest: float
    centroids: np.ndarray
    rotation: np.ndarray
    probes: int

    def extended(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        rest = np.zeros(len(x)) if query else np.sqrt(np.maximum(self.longest**2 - (x**2).sum(axis=1), 0))
        return np.column_stack((x, rest))

    def nearest_lists(self, extended: np.ndarray, count: int) -> np.ndarray:
        far = (self.centroids**2).sum(axis=1) - 2 * extended @ self.centroids.T
        if count >= far.shape[1]:
            return np.argsort(far, axis=1, kind="stable")
        near = np.argpartition(far, count - 1, axis=1)[:, :count]
        return near


def _kmeans(x: np.ndarray, count: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    distinct = np.unique(x, axis=0)
    centroids = distinct[rng.permutation(len(distinct))[:count]]
    for _ in range(rounds):
        own = ((centroids**2).sum(axis=1) - 2 * x @ centroids.T).argmin(axis=1)
        sizes = np.bincount(own, minlength=len(centroids))
        order = np.argsort(own, kind="stable")
        starts = np.concatenate(([0], np.cumsum(sizes)))[:-1]
        filled = sizes > 0
        centroids = centroids.copy()
        centroids[filled] = np.add.reduceat(x[order], starts[filled], axis=0) / sizes[filled, None]
    return centroids


def _usable(vectors: DataFrame) -> DataFrame:
    """``(vec_id, x)`` of the rows that take part, with ``x`` as doubles."""
    cast = F.col("embedding").cast("array<double>")
    finite = "forall(x, v -> v IS NOT NULL AND NOT isnan(v) AND abs(v) < double('inf'))"
    return (
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), cast.alias("x"))
        .where(f"vec_id IS NOT NULL AND x IS NOT NULL AND {finite} AND exists(x, v -> v <> 0)")
    )


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)


def fit(rows: DataFrame, nearest: int = NEAREST, seed: int = 1) -> Index | None:
    """An index from the ``SAMPLE`` rows ``(vec_id, x)`` whose hashed ids are smallest, or
    None if there are no rows. The dimension is the most frequent one.
    """
    sizes = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    if not sizes:
        return None
    dimension, count = sizes[0]
    rows = rows.where(F.size("x") == dimension)
    longest = rows.agg(F.max(F.expr("sqrt(aggregate(x, 0D, (s, v) -> s + v * v))"))).first()[0]
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toArrow()
    x = _matrix(sample.column("x").combine_chunks(), dimension).astype(np.float64)
    rng = np.random.default_rng(seed)
    rotation = np.linalg.qr(rng.normal(size=(dimension + 1, dimension + 1)))[0]
    index = Index(dimension, longest * (1 + 1e-12), np.zeros((1, dimension + 1)), rotation, 1)
    extended = index.extended(x)
    index.centroids = _kmeans(extended, min(LISTS, 1 + count // LIST_ROWS), rng)
    # The fewest lists that hold the wanted share of a few sample queries' neighbours.
    asked = x[rng.permutation(len(x))[:SAMPLE_QUERIES]]
    best = np.argsort(-(asked @ x.T), axis=1, kind="stable")[:, : nearest + 1]
    own = index.nearest_lists(extended, 1)[:, 0]
    order = index.nearest_lists(index.extended(asked, query=True), len(index.centroids))
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(order.shape[1])[None], axis=1)
    needed = np.sort(np.take_along_axis(place, own[best], axis=1).ravel())
    index.probes = int(needed[int(np.ceil(RECALL * len(needed))) - 1]) + 1
    return index


class _List:
    """Vectors of one list, rotated and in blocks of columns."""

    def __init__(self, index: Index, ids: np.ndarray, x: np.ndarray):
        self.index, self.ids, self.x = index, ids, x
        rotated = index.extended(x) @ index.rotation
        self.width = rotated.shape[1]
        self.blocks = [np.ascontiguousarray(rotated[:, k : k + COLUMNS]) for k in range(0, self.width, COLUMNS)]
        self.first = (self.blocks[0] ** 2).sum(axis=1)
        self.head = np.ascontiguousarray(rotated[:HEAD])

    def search(self, own: np.ndarray, q: np.ndarray, nearest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each query its nearest: their places in the list and scores."""
        turned = self.index.extended(q, query=True) @ self.index.rotation
        # The bound: the worst of the nearest among the list's first vectors.
        bound = np.full(len(q), np.inf)
        if len(self.head) > nearest:
            far = (self.head**2).sum(axis=1) + (turned**2).sum(axis=1)[:, None] - 2 * turned @ self.head.T
            far[own[:, None] == self.ids[None, : len(self.head)]] = np.inf
            bound = np.partition(far, nearest - 1, axis=1)[:, nearest - 1]
        bound = np.maximum(bound, 0) * (1 + 1e-9) + 1e-9 * self.index.longest**2
        start = turned[:, :COLUMNS]
        partial = self.first + (start**2).sum(axis=1)[:, None] - 2 * start @ self.blocks[0].T
        for k in range(len(q)):
            alive, seen = np.flatnonzero(self.ids != own[k]), self.blocks[0].shape[1]
            far = partial[k, alive]
            for block in self.blocks[1:]:
                alive, far = self._promising(alive, far, seen, bound[k])
                step = block[alive] - turned[k, seen : seen + block.shape[1]]
                far = far + np.einsum("ij,ij->i", step, step)
                seen += block.shape[1]
            alive, far = self._promising(alive, far, seen, bound[k])
            score = (self.x[alive] * q[k]).sum(axis=1)
            order = np.lexsort((self.ids[alive], -score))[:nearest]
            yield alive[order], score[order]

    def _promising(self, alive: np.ndarray, far: np.ndarray, seen: int, bound: float) -> tuple[np.ndarray, np.ndarray]:
        """Without the candidates whose distance in ``seen`` columns says, at the test's
        significance, that they are beyond the bound; it strays by about 1 / sqrt(seen).
        """
        slack = 1.0 if seen == self.width else (1 + SIGNIFICANCE / np.sqrt(seen)) ** 2
        keep = far * (self.width / seen) <= bound * slack
        return alive[keep], far[keep]


def nearest_neighbours(
    vectors: DataFrame, queries: Column, nearest: int = NEAREST, chunk: int = CHUNK
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row of ``(vec_id, embedding)`` that
    the condition ``queries`` on ``vec_id`` selects, the ``nearest`` other rows found with
    the largest inner products, ranks from 1, ties to the smaller vec_id.

    Null or zero vectors, vectors with null or non-finite components or of another
    than the most frequent dimension, and null ids take no part. Rows that repeat a
    vec_id are candidates one by one, but not of a query with that id, and one query.
    With fewer candidates a query has all of them in the probed lists, and all lists
    are probed if they are few. Other columns are ignored; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    rows = _usable(vectors)
    index = fit(rows, nearest)
    if index is None:
        return spark.createDataFrame([], schema)
    shared = spark.sparkContext.broadcast(cloudpickle.dumps(index))  # at most LISTS centroids
    dimension = index.dimension

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = cloudpickle.loads(shared.value)
        for batch in batches:
            x = _matrix(batch.column("x"), dimension)
            own = known.nearest_lists(known.extended(x), 1)[:, 0] if len(x) else np.empty(0)
            stored = pa.array([v.tobytes() for v in x], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(own.astype(np.int32)), batch.column("vec_id"), stored], ["list", "vec_id", "x"])

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = cloudpickle.loads(shared.value)
        for batch in batches:
            x = np.frombuffer(b"".join(batch.column("x").to_pylist()), np.float64).reshape(-1, dimension)
            lists = known.nearest_lists(known.extended(x, query=True), known.probes) if len(x) else np.empty((0, 1))
            each = np.repeat(np.arange(len(x)), lists.shape[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(lists.ravel().astype(np.int32)), batch.column("vec_id").take(pa.array(each)), batch.column("x").take(pa.array(each))],
                ["list", "vec_id", "x"],
            )

    placed = "list int, vec_id long, x binary"
    indexed = materialize(rows.where(F.size("x") == dimension).mapInArrow(assign, placed), "lists")
    asked = indexed.where(queries).dropDuplicates(["vec_id"]).mapInArrow(probe, placed)
    asked = materialize(asked, "probes")
    # One row for each list, so at most LISTS.
    cut = "int(1 + (count(*) - 1) div {})".format
    sizes = F.broadcast(
        indexed.groupBy("list").agg(F.expr(f"{cut(chunk)} AS chunks"))
        .join(asked.groupBy("list").agg(F.expr(f"{cut(chunk)} AS blocks")), "list")
    )
    left = indexed.join(sizes, "list").select(
        "list", F.expr("int(pmod(xxhash64(vec_id), chunks))").alias("chunk"), F.expr("explode(sequence(0, blocks - 1))").alias("block"), "vec_id", "x"
    )
    right = asked.join(sizes, "list").select(
        "list", F.expr("explode(sequence(0, chunks - 1))").alias("chunk"), F.expr("int(pmod(xxhash64(vec_id), blocks))").alias("block"), "vec_id", "x"
    )

    def search(key: tuple, lists: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(lists) and len(asked):
            x, q = (np.frombuffer(b"".join(f.x), np.float64).reshape(-1, dimension) for f in (lists, asked))
            own = asked.vec_id.to_numpy()
            scanned = _List(cloudpickle.loads(shared.value), lists.vec_id.to_numpy(), x)
            for begin in range(0, len(q), QUERIES):
                part = slice(begin, begin + QUERIES)
                for query, (places, scores) in zip(own[part], scanned.search(own[part], q[part], nearest), strict=True):
                    found.append((query, key[1] // 64, scanned.ids[places].tolist(), scores.tolist()))
        return pd.DataFrame(found, columns=["query_id", "part", "ids", "scores"])

    keys = ("list", "chunk", "block")
    lists = left.groupBy(*keys).cogroup(right.groupBy(*keys))
    lists = lists.applyInPandas(search, "query_id long, part int, ids array<long>, scores array<double>")
    best = f"slice(array_sort(flatten(collect_list({{}}))), 1, {nearest})".format
    merged = (
        lists.select("query_id", "part", F.expr("zip_with(scores, ids, (s, i) -> named_struct('less', -s, 'vec_id', i))").alias("found"))
        .groupBy("query_id", "part").agg(F.expr(best("found")).alias("found"))
        .groupBy("query_id").agg(F.expr(best("found")).alias("found"))
    )
    return merged.select("query_id", F.posexplode("found").alias("place", "one")).select(
        "query_id", (F.col("place") + 1).alias("rank"), F.col("one.vec_id").alias("vec_id"), (-F.col("one.less")).alias("score")
    )
