"""Adjacency lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tricycle.operators.pairs import weighted_edges
from tricycle.plans.order import numbered
from tricycle.plans.skew import HOT_KEYS, SLICE_COPIES, looked_up, sliced

# Entries of one array.
BLOCK_SIZE = 100_000


def adjacency(edges: DataFrame, block_size: int = BLOCK_SIZE, limit: int = HOT_KEYS) -> DataFrame:
    """``(follower, block, followees ARRAY<LONG>)``, sorted, duplicates kept.

    ``block`` is the position in the follower's whole sorted list div ``block_size``,
    whatever the graph: each block but the last has ``block_size`` entries, and the
    blocks in order are the sorted list. Edges with a null id are in no list.

    Lists of up to ``block_size`` entries are one block and are gathered as they are. The
    entries of longer ones are numbered in order of follower and user (``numbered``); an
    entry's position is its place less that of its list's first entry. How many lists are
    longer is counted first, so that a graph without any has the plan of the short ones.
    """
    # Null users are in no count or list anyway; a filter would work out the ids twice.
    lists = edges.groupBy("follower").agg(F.count("user").alias("n_followees"))
    longest = lists.agg(F.max(F.expr("if(follower IS NULL, 0L, n_followees)"))).first()[0]
    known = edges.where("follower IS NOT NULL").select("follower", "user")
    if not longest or longest <= block_size:
        return _gathered(known.selectExpr("follower", "0 AS block", "user"))
    lists = lists.where(f"n_followees > {block_size}")
    sized = looked_up(known, ["follower"], lists, "n_followees", limit, block_size)
    short = sized.where("n_followees IS NULL").selectExpr("follower", "0 AS block", "user")
    return _gathered(short).unionByName(_gathered(_placed(sized.where("n_followees IS NOT NULL"), block_size, limit)))


def _gathered(rows: DataFrame) -> DataFrame:
    lists = rows.groupBy("follower", "block").agg(F.sort_array(F.collect_list("user")).alias("followees"))
    return lists.where("size(followees) > 0")


def _placed(rows: DataFrame, block_size: int, limit: int) -> DataFrame:
    """``(follower, block, user)`` of the entries of long lists. Duplicates travel as one
    row for 256 of them.
    """
    folded = sliced(weighted_edges(rows), "n_edges", SLICE_COPIES)
    entries = numbered(folded, "follower", "user", "slice", copies="n_edges").drop("slice")
    # A long list has more than block_size entries, so there are few of them.
    lists = entries.groupBy("follower").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    found = looked_up(entries, ["follower"], lists, "n", limit, how="inner")
    return found.selectExpr("follower", f"int((place - first) div {block_size}) AS block", "user")


def adjacency_edges(lists: DataFrame) -> DataFrame:
    """Adjacency lists back to edges, one per list entry."""
    return lists.selectExpr("follower", "explode(followees) AS user")
