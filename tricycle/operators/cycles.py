"""Directed 3-cycles.

Each cycle is found from its node of lowest rank, where rank is the degree and then
the id. Only neighbours of higher rank are paired there. Few nodes can outrank a hub:
with ``n`` linked pairs a node of degree ``d`` has at most ``2n / d`` neighbours of its
degree or more, so a node that a third of all edges touch is no more work than
another. Two-paths through hubs are never built. A longer list of neighbours, which
can have up to ``sqrt(2n)``, is cut into blocks that are paired block by block.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tricycle.functions import cell_of, cells, every_cell
from tricycle.operators.graph import PLAIN_PATHS, Graph, chosen, graph_of
from tricycle.operators.pairs import linked_pairs, ranked_pairs
from tricycle.operators.plain import joined_paths
from tricycle.plans.bitmap import BITMAP_BITS, key_bitmap, maybe_among
from tricycle.plans.report import RunCounters, noted
from tricycle.plans.skew import CELL_ROWS, HOT_KEYS
from tricycle.plans.strategy import BROADCAST_EDGES, hinted

# Neighbours of one node that one join cell pairs with as many others.
BLOCK_ROWS = 10_000


def wedges(
    table: DataFrame,
    strategy: str,
    limit: int = HOT_KEYS,
    block_rows: int = BLOCK_ROWS,
    bits: int = 0,
    counters: RunCounters | None = None,
) -> DataFrame:
    """``(u, a, b, ua, au, ub, bu, degree_a, degree_b)``: two neighbours ``a < b``
    of a lowest-ranked ``u``, with the edge counts u→a, a→u, u→b, b→u. Only those
    that one closing edge can make a cycle.

    The neighbours of ``u`` are hashed to blocks of about ``block_rows``; block ``i`` meets
    each block ``j >= i`` in a cell of its own, so each two neighbours meet once.

    With ``bits``, wedges whose ends are not linked are dropped by a bitmap of so many bits,
    but for those that it cannot tell. ``counters`` gets the ``largest_cell`` (pairs of
    neighbours in one), the ``wedges`` and, with ``bits``, those that are left
    (``wedges_kept``).
    """
    swap = "degree_a > degree_b"
    pairs = linked_pairs(table).select(F.expr("count(fwd + bwd + loops)")).scalar()
    upward = ranked_pairs(table, limit).selectExpr(
        f"if({swap}, b, a) AS u",
        f"if({swap}, a, b) AS v",
        f"if({swap}, bwd, fwd) AS uv",
        f"if({swap}, fwd, bwd) AS vu",
        "least(degree_a, degree_b) AS degree_u",
        "greatest(degree_a, degree_b) AS degree_v",
    )
    upward = (
        upward.withColumn("longest", F.least(F.col("degree_u"), 2 * pairs / F.col("degree_u")).cast("long"))
        .withColumn("blocks", F.expr(cells("longest", block_rows)))
        .withColumn("block", F.expr(cell_of("v", "blocks")))
    )
    one = upward.selectExpr(
        "u", "v AS v1", "uv AS ua", "vu AS au", "degree_v AS degree_1", "block AS i", "explode(sequence(block, blocks - 1)) AS j"
    )
    two = upward.selectExpr(
        "u", "v AS v2", "uv AS ub", "vu AS bu", "degree_v AS degree_2", "explode(sequence(0, block)) AS i", "block AS j"
    )
    turned = "v1 > v2"
    if counters is not None:
        # As the join is dealt, so that a shuffle join needs no further one for this.
        cell = Window.partitionBy("u", "i", "j")
        one = one.withColumn("n_1", F.count(F.lit(1)).over(cell))
        two = two.withColumn("n_2", F.count(F.lit(1)).over(cell))
    met = one.join(hinted(two, strategy), ["u", "i", "j"])
    if counters is not None:
        met = counters.on(met, largest_cell="max(n_1 * n_2)")
    opened = (
        met.where("(v1 < v2 OR i < j) AND (au > 0 AND ub > 0 OR ua > 0 AND bu > 0)")
        # v1 and v2 behind least and greatest: else a < b would be inferred for
        # the closing pairs and pushed below their shuffle, which is shared.
        .selectExpr(
            "u",
            "least(v1, v2) AS a",
            "greatest(v1, v2) AS b",
            *(f"if({turned}, {y}, {x}) AS {x}" for x, y in (("ua", "ub"), ("au", "bu"))),
            *(f"if({turned}, {x}, {y}) AS {y}" for x, y in (("ua", "ub"), ("au", "bu"))),
            f"if({turned}, degree_2, degree_1) AS degree_a",
            f"if({turned}, degree_1, degree_2) AS degree_b",
        )
        .select("u", "a", "b", "ua", "au", "ub", "bu", "degree_a", "degree_b")
    )
    if counters is not None:
        opened = counters.on(opened, wedges="count(*)")
    if bits:
        opened = maybe_among(opened, ["a", "b"], key_bitmap(linked_pairs(table), ["a", "b"], bits), bits)
        if counters is not None:
            opened = counters.on(opened, wedges_kept="count(*)")
    return opened


def weighted_cycles(
    table: DataFrame,
    strategy: str,
    cell_rows: int = CELL_ROWS,
    limit: int = HOT_KEYS,
    block_rows: int = BLOCK_ROWS,
    bits: int = 0,
    counters: RunCounters | None = None,
) -> DataFrame:
    """``(x, y, z, xy, yz, zx)``: each directed 3-cycle of distinct nodes once, the
    smallest node first, with the number of edges on each of its sides.

    A closing pair of two hubs can have a wedge at almost every node; its wedges
    are split over several join cells by their lowest-ranked node.
    """
    ranked = ranked_pairs(table, limit)
    n_cells = cells("least(degree_a, degree_b)", cell_rows)
    closing = ranked.selectExpr("a", "b", "fwd", "bwd", f"{every_cell(n_cells)} AS cell")
    opened = wedges(table, strategy, limit, block_rows, bits, counters).selectExpr(
        "u", "a", "b", "ua", "au", "ub", "bu", f"{cell_of('u', n_cells)} AS cell"
    )
    # u→a→b→u and u→b→a→u. As a < b, the smallest node is u or a.
    turns = (
        ("u a b ua fwd bu", "a b u fwd bu ua"),
        ("u b a ub bwd au", "a u b au ub bwd"),
    )
    rows = (
        ", ".join(f"if(u < a, {kept}, {turned})" for kept, turned in zip(from_u.split(), from_a.split()))
        for from_u, from_a in turns
    )
    found = (
        opened.join(hinted(closing, strategy), ["a", "b", "cell"])
        .selectExpr(f"stack(2, {', '.join(rows)}) AS (x, y, z, xy, yz, zx)")
        .where("xy > 0 AND yz > 0 AND zx > 0")
    )
    return found if counters is None else counters.on(found, closing_hits="count(*)")


def cycle_list(
    edges: DataFrame | Graph,
    strategy: str = "auto",
    cell_rows: int = CELL_ROWS,
    limit: int = HOT_KEYS,
    block_rows: int = BLOCK_ROWS,
    broadcast_edges: int = BROADCAST_EDGES,
    plain_paths: int = PLAIN_PATHS,
    bitmap_bits: int = BITMAP_BITS,
    counters: RunCounters | None = None,
) -> DataFrame:
    """Each directed 3-cycle x→y→z→x of distinct nodes once, with ``x < y, x < z``. For
    ``plain_paths``, ``bitmap_bits`` and ``counters`` see ``triangle_count``.
    """
    graph = graph_of(edges)
    resolved = graph.strategy(strategy, broadcast_edges)
    plain = graph.plain_strategy(resolved, plain_paths, broadcast_edges)
    if plain is not None:
        found = joined_paths(graph.weighted(), "cycle", plain, counters).where("x < y AND x < z")
    else:
        bits = graph.bitmap_bits(resolved, bitmap_bits)
        found = weighted_cycles(graph.pairs, resolved, cell_rows, limit, block_rows, bits, counters)
    return noted(found.select("x", "y", "z"), chosen(graph, plain, resolved))
