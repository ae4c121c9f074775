"""Join strategy by name, with a size check in front of every broadcast."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STRATEGIES = ("auto", "merge", "broadcast")

# Rows of a broadcast edge table: up to six LONGs each, twice that as a hash table.
BROADCAST_EDGES = 2_000_000


# Parts of a sketch, by a hash of the edge, the logarithm of its registers, and four
# times its relative standard error of 1.04 / sqrt(2 ** 14).
SKETCH_PARTS = 16
SKETCH_LOG = 14
SKETCH_ERROR = 0.033


def resolve(strategy: str, edges: DataFrame, folded: DataFrame, limit: int = BROADCAST_EDGES) -> str:
    """The strategy to plan with.

    ``broadcast`` sends ``folded``, the distinct rows of ``edges``, to every task. It is
    checked to have at most ``limit`` rows, by a sketch, and where that is too close to
    tell by a count. Above it a warning says so and the join is a merge. ``auto`` leaves
    the choice to Catalyst and AQE.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown join strategy {strategy!r}, expected one of {STRATEGIES}")
    if strategy == "broadcast":
        n = distinct_edges(edges)
        close = abs(n - limit) <= SKETCH_ERROR * n
        if (folded.count() if close else n) > limit:
            warnings.warn(f"more than {limit} distinct edges to broadcast: joining by merge instead", stacklevel=4)
            return "merge"
    return strategy


def sketched_edges(edges: DataFrame) -> DataFrame:
    """``(part, n)``: about how many distinct edges fall into each of a few parts, from
    HyperLogLog sketches that are made before the shuffle, so that it moves a sketch for each
    task and part whatever the number of edges or duplicates.
    """
    edge = F.xxhash64("follower", "user")
    return (
        edges.where("follower IS NOT NULL AND user IS NOT NULL")
        .select(edge.alias("edge"))
        .groupBy(F.pmod("edge", F.lit(SKETCH_PARTS)).alias("part"))
        .agg(F.hll_sketch_estimate(F.hll_sketch_agg("edge", SKETCH_LOG)).alias("n"))
    )


def distinct_edges(edges: DataFrame) -> int:
    """About how many distinct edges there are."""
    return sum(r.n for r in sketched_edges(edges).collect())  # a row for each part


def hinted(df: DataFrame, strategy: str) -> DataFrame:
    """``df`` as the build side of a join under a resolved strategy."""
    if strategy == "broadcast":
        return F.broadcast(df)
    return df.hint("merge") if strategy == "merge" else df
