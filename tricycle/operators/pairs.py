"""Edges folded to weighted node pairs, the common input of path operators.

One row per unordered node pair carries how many edges run each way, so
duplicates are combined before the first shuffle and never travel again. Every
operator reads the same aggregation, and Spark shuffles it once: the consumers
filter on aggregate results only, which keeps their plans below the shuffle equal
and lets the exchange be reused.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tricycle.functions import cell_of, cells, every_cell
from tricycle.plans.skew import CELL_ROWS, HOT_KEYS, hot_keys

NO_NULL_ID = "follower IS NOT NULL AND user IS NOT NULL"


def weighted_edges(edges: DataFrame) -> DataFrame:
    """Distinct edges ``(follower, user, n_edges)``; edges with a NULL id drop out."""
    return edges.where(NO_NULL_ID).groupBy("follower", "user").agg(F.expr("count(*) AS n_edges"))


def pair_table(edges: DataFrame) -> DataFrame:
    """``(a, b, fwd, bwd, loops)`` with ``a <= b``.

    ``fwd`` counts a→b, ``bwd`` b→a; ``loops`` counts a→a on the rows ``a = b``.
    """
    return (
        edges.where(NO_NULL_ID)
        .groupBy(F.expr("least(follower, user) AS a"), F.expr("greatest(follower, user) AS b"))
        .agg(
            F.expr("count_if(follower < user) AS fwd"),
            F.expr("count_if(follower > user) AS bwd"),
            F.expr("count_if(follower = user) AS loops"),
        )
        # Already true. Joins on a and b would infer it on one side only and
        # push it below the shuffle, which would then not be shared.
        .where("a IS NOT NULL AND b IS NOT NULL")
    )


def linked_pairs(table: DataFrame) -> DataFrame:
    """Pairs of two nodes. Reads all counts, so that pruning drops none of them."""
    return table.where("fwd + bwd > loops")


def self_loops(table: DataFrame) -> DataFrame:
    """``(node, n_loops)``."""
    return table.where("loops > fwd + bwd").selectExpr("a AS node", "loops AS n_loops")


def degrees(table: DataFrame) -> DataFrame:
    """``(node, degree)``: how many other nodes each node is linked to."""
    return (
        linked_pairs(table).selectExpr("explode(array(a, b)) AS node").groupBy("node").agg(F.expr("count(*) AS degree"))
    )


def ranked_pairs(table: DataFrame, limit: int = HOT_KEYS) -> DataFrame:
    """Linked pairs with the degrees ``degree_a`` and ``degree_b`` of their ends.

    The degrees of hot nodes come by broadcast, all of them on a graph of up to
    ``limit`` nodes. A pair with another end is shuffled by that end, so a hub's pairs
    never meet at the hub. The pairs of a prepared graph have them already.
    """
    if "degree_a" in table.columns:
        return linked_pairs(table).select("a", "b", "fwd", "bwd", "degree_a", "degree_b")
    every = degrees(table)
    hot = F.broadcast(hot_keys(every, "degree", limit))
    marked = (
        linked_pairs(table)
        .select("a", "b", "fwd", "bwd")
        .join(hot.toDF("a", "degree_a"), "a", "left")
        .join(hot.toDF("b", "degree_b"), "b", "left")
    )
    known = marked.where("degree_a IS NOT NULL AND degree_b IS NOT NULL")
    # Of two cold ends each is looked up, of one that one, whichever it is.
    others = (
        marked.where("degree_a IS NULL OR degree_b IS NULL")
        .selectExpr("*", "if(degree_a IS NULL, a, b) AS one", "if(degree_b IS NULL, b, a) AS two")
        .join(every.toDF("one", "degree_one"), "one", "left")
        .join(every.toDF("two", "degree_two"), "two", "left")
        .selectExpr(
            "a", "b", "fwd", "bwd", "coalesce(degree_a, degree_one) AS degree_a", "coalesce(degree_b, degree_two) AS degree_b"
        )
    )
    return known.unionByName(others)


def looped_neighbours(table: DataFrame, limit: int = HOT_KEYS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """``(node, other, n_out, n_in, n_loops)``: nodes with a self-loop and their
    neighbours linked both ways. A hub's rows are split over several join cells.
    """
    columns = "node, other, n_out, n_in, n_cells"
    ends = (
        ranked_pairs(table, limit)
        .where("fwd > 0 AND bwd > 0")
        .selectExpr(
            f"stack(2, a, b, fwd, bwd, {cells('degree_a', cell_rows)},"
            f" b, a, bwd, fwd, {cells('degree_b', cell_rows)}) AS ({columns})"
        )
        .selectExpr("node", "other", "n_out", "n_in", f"{cell_of('other', 'n_cells')} AS cell")
    )
    loops = (
        self_loops(table)
        .join(degrees(table), "node", "left")
        .selectExpr("node", "n_loops", f"{every_cell(cells('degree', cell_rows))} AS cell")
    )
    return ends.join(loops, ["node", "cell"]).drop("cell")
