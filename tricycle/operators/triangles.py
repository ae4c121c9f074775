"""Triangle counts under named semantics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tricycle.functions import third
from tricycle.operators.cycles import BLOCK_ROWS, wedges
from tricycle.operators.graph import PLAIN_PATHS, Graph, chosen, graph_of
from tricycle.operators.pairs import linked_pairs
from tricycle.operators.plain import joined_paths
from tricycle.plans.bitmap import BITMAP_BITS
from tricycle.plans.report import RunCounters, noted
from tricycle.plans.skew import HOT_KEYS
from tricycle.plans.strategy import BROADCAST_EDGES, hinted

SEMANTICS = ("bag", "semi", "walk", "cycle")


def triangle_count(
    edges: DataFrame | Graph,
    semantics: str = "bag",
    strategy: str = "auto",
    limit: int = HOT_KEYS,
    block_rows: int = BLOCK_ROWS,
    broadcast_edges: int = BROADCAST_EDGES,
    plain_paths: int = PLAIN_PATHS,
    bitmap_bits: int = BITMAP_BITS,
    counters: RunCounters | None = None,
) -> DataFrame:
    """One row ``(closed_paths, triangles)``.

    ========  ====================  ======  =======================
    semantic  first two hops        x <> z  closing edge
    ========  ====================  ======  =======================
    bag       every duplicate       yes     every duplicate
    semi      every duplicate       yes     exists
    walk      every duplicate       no      exists
    cycle     distinct, loop-free   yes     distinct
    ========  ====================  ======  =======================

    ``triangles`` is ``closed_paths div 3``, which is exact without self-loops and,
    for semi and walk, without duplicates. No path is listed: wedges are summed per
    closing pair before they are shuffled. A count beyond LONG raises under ANSI.

    A graph with about ``plain_paths`` two-paths or fewer (or four for each edge) is joined
    plainly instead; ``explain_text`` says which was chosen. 0 never does.

    Where pairs are not broadcast, wedges whose ends are not linked are dropped by a bitmap
    of the pairs, of up to ``bitmap_bits`` bits, before the shuffle; 0 never does. ``counters``
    observes the steps: see ``wedges`` and ``joined_paths``; ``closing_hits`` by degree are
    pairs that close a wedge in either direction.
    """
    if semantics not in SEMANTICS:
        raise ValueError(f"unknown semantics {semantics!r}, expected one of {SEMANTICS}")
    graph = graph_of(edges)
    resolved = graph.strategy(strategy, broadcast_edges)
    plain = graph.plain_strategy(resolved, plain_paths, broadcast_edges)
    if plain is not None:
        parts = joined_paths(graph.weighted(), semantics, plain, counters).selectExpr("copies AS closed_paths")
    else:
        bits = graph.bitmap_bits(resolved, bitmap_bits)
        parts = _cycle_paths(graph.pairs, semantics, resolved, limit, block_rows, bits, counters)
        if semantics != "cycle":
            parts = parts.unionByName(_loop_paths(graph.pairs, semantics))
    closed = parts.agg(F.expr("coalesce(sum(closed_paths), 0L) AS closed_paths"))
    closed = closed.selectExpr("closed_paths", f"{third('closed_paths')} AS triangles")
    return noted(closed, chosen(graph, plain, resolved))


def _cycle_paths(
    table: DataFrame,
    semantics: str,
    strategy: str,
    limit: int,
    block_rows: int,
    bits: int = 0,
    counters: RunCounters | None = None,
) -> DataFrame:
    """One row: closed paths on three distinct nodes.

    A wedge at ``u`` makes the cycle u→a→b→u if a→b exists and the cycle
    u→b→a→u if b→a exists. A cycle with sides p, q, r is 3·p·q·r closed paths in a
    bag and pq + qr + rp if the closing side counts once.
    """
    opened = wedges(table, strategy, limit, block_rows, bits, counters)
    # Per direction: the product, for semi and walk also the sum, of the wedge's
    # sides; the closing side is a factor that comes with the join.
    if semantics == "cycle":
        sides = {"ab": "int(ua > 0 and bu > 0)", "ba": "int(ub > 0 and au > 0)"}
        closed = "3 * (int(fwd > 0) * ab + int(bwd > 0) * ba)"
    elif semantics == "bag":
        sides = {"ab": "ua * bu", "ba": "ub * au"}
        closed = "3 * (fwd * ab + bwd * ba)"
    else:
        sides = {
            "ab": "ua * bu",
            "ba": "ub * au",
            "ab_sum": "if(ua > 0 and bu > 0, ua + bu, 0L)",
            "ba_sum": "if(ub > 0 and au > 0, ub + au, 0L)",
        }
        closed = "if(fwd > 0, ab + fwd * ab_sum, 0L) + if(bwd > 0, ba + bwd * ba_sum, 0L)"
    if strategy == "broadcast":
        # The closing pairs are at hand in every task: no shuffle of wedges.
        opened = opened.selectExpr("a", "b", *(f"{e} AS {name}" for name, e in sides.items()))
    else:
        opened = opened.groupBy("a", "b").agg(*(F.expr(f"sum({e}) AS {name}") for name, e in sides.items()))
    met = opened.join(hinted(linked_pairs(table), strategy), ["a", "b"])
    if counters is not None:
        met = counters.on(met, closing_hits="count_if(fwd > 0 AND ab > 0 OR bwd > 0 AND ba > 0)")
    return met.agg(F.expr(f"sum({closed}) AS closed_paths"))


def _loop_paths(table: DataFrame, semantics: str) -> DataFrame:
    """One row: closed paths that use a self-loop, from per-node sums."""
    nodes = (
        table.where("fwd > 0 AND bwd > 0 OR loops > 0")
        # On a self-loop row a = b, and fwd and bwd are 0.
        .selectExpr(
            "explode(array_distinct(array(a, b))) AS node", "loops", "fwd * bwd AS both", "fwd + bwd AS either"
        )
        .groupBy("node")
        .agg(*(F.expr(f"sum({c}) AS {c}") for c in ("loops", "both", "either")))
        .where("loops > 0")
    )
    closed = {
        "bag": "2 * loops * both",
        "semi": "loops * either",
        "walk": "loops * either + both + loops * loops",
    }[semantics]
    return nodes.agg(F.expr(f"sum({closed}) AS closed_paths"))
