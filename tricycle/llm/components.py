"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tricycle.plans import materialize

# Rounds after which a graph that has not settled is reported as an error. A round
# shrinks every path, so that this many rounds are out of reach.
MAX_ROUNDS = 100
LINKS_IN_FILE = 250_000


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to its smallest one (or itself)."""
    both = edges.union(edges.select("v", "u")).toDF("u", "v")
    least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node links itself and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for each node of the links ``(u, v)``: the smallest node
    that can be reached from it.

    Nodes are of any type with an order. Links to itself and links with a null end
    are left out, repeated links count once; no links give an empty table. Both star
    operations are an aggregation with map-side combine and a join, so that a node
    with very many links is spread by the engine, and every round is written to the
    shared folder.
    """
    links, state = _written(edges.toDF("u", "v").where("u <> v").distinct())
    if not state[0]:
        return links.toDF("node", "component")
    # Rounds add no links, so that their tables need no more files than this.
    files, before = 1 + state[0] // LINKS_IN_FILE, None
    for _ in range(MAX_ROUNDS):
        links, state = _written(_small_star(_large_star(links)).coalesce(files))
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def _written(links: DataFrame) -> tuple[DataFrame, tuple]:
    """The links in the shared folder, and their number and a sum of their hashes, which
    are gathered while they are written.
    """
    observed = Observation("links")
    total = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    written = materialize(links.observe(observed, F.count(F.lit(1)).alias("n"), total.alias("total")), "links")
    return written, (observed.get["n"], observed.get["total"])


def joined_components(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``(node, component)`` after further ``links`` between nodes, some of which have a
    component in ``labels`` already: only the components that the links connect are
    looked at anew.
    """
    ends = links.toDF("u", "v")
    for end in ("u", "v"):
        known = labels.toDF(end, "own")
        ends = ends.join(known, end, "left").withColumn(end, F.coalesce("own", end)).drop("own")
    moved = materialize(components(ends.select("u", "v")), "joined")
    joined = labels.join(moved.toDF("component", "after"), "component", "left").select(
        "node", F.coalesce("after", "component").alias("component")
    )
    # Nodes that had no component, or stand for one already.
    return joined.union(moved.join(labels, "node", "left_anti"))
