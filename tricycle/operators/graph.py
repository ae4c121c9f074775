"""A graph's folded pairs, its size, and the choice between two ways to find cycles.

The plain way joins edges three times and builds every two-path. How many there are is
known beforehand from one aggregation: the in-edges times the out-edges of each node. Where
they are few, and no node has a large share, nothing beats it. Elsewhere cycles are found
from their nodes of lowest degree (``cycles``).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tricycle.operators.pairs import pair_table, ranked_pairs
from tricycle.operators.subgraph import induced_subgraph
from tricycle.plans.bitmap import bits_for
from tricycle.plans.shared import materialize
from tricycle.plans.skew import CELL_ROWS, HOT_KEYS
from tricycle.plans.strategy import BROADCAST_EDGES, resolve

# Two-paths up to which edges are joined plainly: this many, and so many for each edge.
PLAIN_PATHS = 20_000_000
PLAIN_PATHS_PER_EDGE = 4
# Two-paths through one node that a task may build, as in a cell of ``cycles``.
PLAIN_MIDDLE = 100_000_000
# Edges that a plain join broadcasts without being asked: 16 bytes each.
SMALL_EDGES = 500_000


@dataclass(frozen=True)
class GraphSize:
    """``n_edges``, their two-paths ``n_paths``, of which ``most_at_node`` have the same
    middle, and the most edges into or out of a node (``widest``).
    """

    n_edges: int
    n_paths: float
    most_at_node: float
    widest: int

    def plain(self, plain_paths: int) -> bool:
        return (
            plain_paths > 0
            and self.n_paths <= plain_paths + PLAIN_PATHS_PER_EDGE * self.n_edges
            and self.most_at_node <= PLAIN_MIDDLE
            and self.widest <= CELL_ROWS
        )


def graph_size(weighted: DataFrame) -> GraphSize:
    """One job: a map-side combined sum for each node, and the totals over the nodes."""
    found = (
        weighted.selectExpr("stack(2, user, n_edges, 0L, follower, 0L, n_edges) AS (node, n_in, n_out)")
        .where("node IS NOT NULL")
        .groupBy("node")
        .agg(F.sum("n_in").alias("n_in"), F.sum("n_out").alias("n_out"))
        .selectExpr("n_out", "double(n_in) * n_out AS n_paths", "greatest(n_in, n_out) AS widest")
        .agg(
            *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_out", "n_paths")),
            *(F.coalesce(F.max(c), F.lit(0)).alias(c + "_most") for c in ("n_paths", "widest")),
        )
        .first()
    )
    return GraphSize(found.n_out, found.n_paths, found.n_paths_most, found.widest_most)


class Graph:
    """Edges as the operators read them: ``pairs``, and on demand their ``size``.

    ``edges`` is None for a prepared graph, whose pairs are stored with exact degrees.
    """

    def __init__(self, edges: DataFrame | None, pairs: DataFrame):
        self.edges, self.pairs = edges, pairs

    @cached_property
    def size(self) -> GraphSize:
        return graph_size(self.weighted())

    @cached_property
    def heaviest(self) -> int:
        """The most edges of one direction between two nodes."""
        return self.pairs.agg(F.max(F.greatest("fwd", "bwd", "loops"))).first()[0] or 0

    def weighted(self) -> DataFrame:
        """``(follower, user, n_edges)``: edges as they come with 1 each, which may have null
        ids, or each distinct edge of a prepared graph.
        """
        if self.edges is not None:
            return self.edges.selectExpr("follower", "user", "1L AS n_edges")
        rows = "stack(3, a, b, fwd, b, a, bwd, a, a, loops) AS (follower, user, n_edges)"
        return self.pairs.selectExpr(rows).where("n_edges > 0")

    def strategy(self, name: str, limit: int) -> str:
        """The join strategy to plan with; see ``resolve``. Few edges need no other check."""
        if name == "broadcast" and self.size.n_edges <= limit:
            return name
        return resolve(name, self.weighted(), self.pairs, limit)

    def plain_strategy(self, name: str, plain_paths: int, limit: int = BROADCAST_EDGES) -> str | None:
        """The strategy of three plain joins, or None where cycles are to be found by degree."""
        if plain_paths <= 0 or not self.size.plain(plain_paths):
            return None
        if name == "auto" and self.size.n_edges <= min(SMALL_EDGES, limit):
            return "broadcast"
        # Plain joins send edges with their duplicates.
        return None if name == "broadcast" and self.size.n_edges > limit else name

    def bitmap_bits(self, strategy: str, most: int) -> int:
        """Bits of a bitmap of the pairs, 0 where each task has the pairs themselves."""
        return 0 if strategy == "broadcast" or most <= 0 else bits_for(self.size.n_edges, most)


def graph_of(edges: DataFrame | Graph) -> Graph:
    return edges if isinstance(edges, Graph) else Graph(edges, pair_table(edges))


def prepare_graph(edges: DataFrame, max_id: int | None = None, limit: int = HOT_KEYS) -> Graph:
    """Edges filtered, folded and stored once, with exact degrees, for several operators.

    ``triangle_count``, ``closed_paths_bag``, ``closed_paths_semi``, ``cycle_list`` and
    ``two_path_count`` take it in place of edges and read neither the edges nor count
    degrees again. The table is in the shared folder; the size is gathered once, too.
    """
    pairs = materialize(pair_table(induced_subgraph(edges, max_id)), "pairs")
    ranked = ranked_pairs(pairs, limit).withColumn("loops", F.lit(0).cast("long"))
    none = F.lit(None).cast("long")
    loops = pairs.where("loops > fwd + bwd").withColumns({"degree_a": none, "degree_b": none})
    return Graph(None, materialize(ranked.unionByName(loops), "graph"))


def chosen(graph: Graph, plain: str | None, strategy: str) -> str:
    """A line for ``explain_text``."""
    if plain is None:
        return f"cycles from nodes of lowest degree, strategy {strategy}"
    return f"three plain joins, strategy {plain}: about {graph.size.n_paths:.0f} two-paths of {graph.size.n_edges} edges"


