"""Follower counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tricycle.plans.skew import CHUNK_COPIES, expand_copies, repeated, sliced


def follower_count(edges: DataFrame, sort: bool = False) -> DataFrame:
    """``(user, n_followers)`` of every user with a follower.

    Duplicate edges count, and a NULL user forms a group. Counts are partial
    before the shuffle, so a hub sends one row per map task.
    """
    counts = edges.groupBy("user").agg(F.expr("count(*) AS n_followers"))
    return _ranked(counts) if sort else counts


def follower_count_all(nodes: DataFrame, edges: DataFrame, sort: bool = True) -> DataFrame:
    """``(user, n_followers)`` of every node row, 0 for a node without followers.

    Same rows as a left outer join of ``nodes`` with the counts, made as one
    aggregation over both tables: both are combined before the shuffle, so
    neither a hub nor an often repeated node row gathers in one task. Repeated
    node rows are kept, a NULL node has 0, users outside ``nodes`` are dropped.
    """
    tagged = nodes.selectExpr("user", "1 AS copies", "0 AS n_followers").unionByName(
        edges.where("user IS NOT NULL").selectExpr("user", "0 AS copies", "1 AS n_followers")
    )
    counts = (
        tagged.groupBy("user")
        .agg(F.expr("sum(copies) AS copies"), F.expr("sum(n_followers) AS n_followers"))
        .where("copies > 0")
    )
    if not sort:
        return expand_copies(counts)
    # Sorted while compact; the slices of a repeated node row sort apart.
    ranked = _ranked(sliced(counts, "copies", CHUNK_COPIES), "slice")
    return repeated(ranked, "user", "n_followers")


def _ranked(counts: DataFrame, *then: str) -> DataFrame:
    return counts.orderBy(F.desc("n_followers"), F.asc("user"), *then)
