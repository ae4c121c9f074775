"""Closed two-paths, listed. See ``triangles`` for counting them."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tricycle.operators.cycles import BLOCK_ROWS, weighted_cycles
from tricycle.operators.graph import PLAIN_PATHS, Graph, chosen, graph_of
from tricycle.operators.pairs import looped_neighbours, self_loops
from tricycle.operators.plain import joined_paths
from tricycle.plans.bitmap import BITMAP_BITS
from tricycle.plans.report import RunCounters, noted
from tricycle.plans.shared import materialize
from tricycle.plans.skew import CELL_ROWS, CHUNK_COPIES, HOT_KEYS, expand_copies, repeated
from tricycle.plans.strategy import BROADCAST_EDGES


def closed_paths_bag(edges: DataFrame | Graph, strategy: str = "auto", **limits: int) -> DataFrame:
    """Two-paths ``x <> z`` joined with the closing edges: a duplicate of the
    closing edge gives the path once more."""
    return _closed_paths(edges, "bag", strategy, **limits)


def closed_paths_semi(
    edges: DataFrame | Graph, strategy: str = "auto", keep_degenerate: bool = False, **limits: int
) -> DataFrame:
    """Two-paths for which a closing edge exists, however many there are.

    With ``keep_degenerate`` also the paths x→y→x at a node with a self-loop.
    """
    return _closed_paths(edges, "walk" if keep_degenerate else "semi", strategy, **limits)


def _closed_paths(
    edges: DataFrame | Graph,
    semantics: str,
    strategy: str,
    cell_rows: int = CELL_ROWS,
    limit: int = HOT_KEYS,
    block_rows: int = BLOCK_ROWS,
    chunk: int = CHUNK_COPIES,
    broadcast_edges: int = BROADCAST_EDGES,
    plain_paths: int = PLAIN_PATHS,
    bitmap_bits: int = BITMAP_BITS,
    counters: RunCounters | None = None,
) -> DataFrame:
    """A closed two-path on three distinct nodes is a cycle seen from one of its
    nodes; any other one uses a self-loop. Both kinds are listed with their number
    of copies, which is multiplied out last.
    """
    graph = graph_of(edges)
    resolved = graph.strategy(strategy, broadcast_edges)
    plain = graph.plain_strategy(resolved, plain_paths, broadcast_edges)
    if plain is not None:
        listed = joined_paths(graph.weighted(), semantics, plain, counters)
    else:
        bits = graph.bitmap_bits(resolved, bitmap_bits)
        cycles = weighted_cycles(graph.pairs, resolved, cell_rows, limit, block_rows, bits, counters)
        listed = _compact(cycles, graph.pairs, semantics, cell_rows, limit)
    return noted(_routed(listed, graph, plain, chunk), chosen(graph, plain, resolved))


def _routed(listed: DataFrame, graph: Graph, plain: str | None, chunk: int) -> DataFrame:
    """Compact rows multiplied out where they are, unless some may have more than ``chunk``
    copies. No row has more than the cube of the most edges of a pair, so that is known
    beforehand. Then the compact rows are written once; only those over the chunk are
    sliced and dealt to other tasks.
    """
    if plain is not None and graph.edges is not None:
        return listed.select("x", "y", "z")  # plain rows of edges as they come are copies
    if graph.heaviest**3 <= chunk:
        return repeated(listed, "x", "y", "z")
    return expand_copies(materialize(listed, "closed-paths"), chunk)


def _compact(cycles: DataFrame, table: DataFrame, semantics: str, cell_rows: int, limit: int) -> DataFrame:
    """``(x, y, z, copies)`` of the closed paths of a pair table and its weighted cycles."""
    bag = semantics == "bag"
    # Each view of a cycle or of a loop with its neighbour: x, y, z, copies.
    cycle_views = (
        ("x, y, z", "xy * yz", "zx"),
        ("y, z, x", "yz * zx", "xy"),
        ("z, x, y", "zx * xy", "yz"),
    )
    rows = _views(cycles, cycle_views, bag)
    loop_views = [
        ("node, node, other", "n_loops * n_out", "n_in"),
        ("other, node, node", "n_in * n_loops", "n_out"),
    ]
    if semantics == "walk":
        loop_views.append(("node, other, node", "n_out * n_in", "n_loops"))
    rows = rows.unionByName(_views(looped_neighbours(table, limit, cell_rows), loop_views, bag))
    if semantics == "walk":
        rows = rows.unionByName(
            self_loops(table).selectExpr("node AS x", "node AS y", "node AS z", "n_loops * n_loops AS copies")
        )
    return rows


def _views(df: DataFrame, views, bag: bool) -> DataFrame:
    """A row per view ``(nodes, product of the two hops, closing edges)``."""
    rows = (f"{nodes}, {hops} * {closing}" if bag else f"{nodes}, {hops}" for nodes, hops, closing in views)
    return df.selectExpr(f"stack({len(views)}, {', '.join(rows)}) AS (x, y, z, copies)")
