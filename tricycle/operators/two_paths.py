"""Two-paths x→y→z and their closing against edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tricycle.functions import cell_of, cells, every_cell, third
from tricycle.operators.graph import SMALL_EDGES, Graph, graph_of
from tricycle.operators.pairs import weighted_edges
from tricycle.plans.bitmap import bits_for, key_bitmap, maybe_among
from tricycle.plans.shared import materialize
from tricycle.plans.skew import CELL_ROWS, HOT_KEYS, SLICE_COPIES, expand_copies, looked_up, repeated, sliced
from tricycle.plans.strategy import BROADCAST_EDGES, hinted, resolve

# In- or out-edges of a middle node that one join cell pairs. Splitting repeats an
# edge once per this many edges on the other side.
GRID_ROWS = 20_000
# Two-paths that one task sums or one bucket stores.
PART_PATHS = 1_000_000


def two_paths(
    edges: DataFrame,
    strategy: str = "auto",
    keep_degenerate: bool = False,
    cell_rows: int = GRID_ROWS,
    limit: int = HOT_KEYS,
    broadcast_edges: int = BROADCAST_EDGES,
) -> DataFrame:
    """Every two-path ``(x, y, z)`` as a bag: each pair of edges x→y, y→z gives a
    row. Paths back to their start (``x = z``) only with ``keep_degenerate``.

    Duplicate edges travel and join as one row per 256 copies and are multiplied
    out afterwards. At a middle node with more than ``cell_rows`` such rows the join is
    split into a grid of cells, so that none pairs more than about ``cell_rows`` in-edges
    with as many out-edges, however large the graph.
    """
    hops = _joined_hops(edges, strategy, keep_degenerate, cell_rows, limit, broadcast_edges)
    return repeated(hops, "x", "y", "z")


def two_path_ends(edges: DataFrame, keep_degenerate: bool = False, small_edges: int = SMALL_EDGES) -> DataFrame:
    """``(z, x, n_paths)``: the ends of ``two_paths``; for a pair ``n_paths`` sums up to how many
    rows there have it. No path is listed: duplicates of edges stay folded and multiply.

    Where the edges out of middle nodes are at most ``small_edges`` they are broadcast to
    the first hops, which are dealt by their start, so that paths are summed where they are
    made, to a row for each pair. Elsewhere the hops are joined as in ``two_paths``, and a
    pair has a row for each middle node (and slice of duplicates).
    """
    folded = weighted_edges(edges)
    size = _middle_degrees(folded).selectExpr("max(n_out) AS widest", "sum(if(n_in > 0, n_out, 0)) AS n_second").first()
    if (size.n_second or 0) <= small_edges and (size.widest or 0) <= CELL_ROWS:
        middles = folded.selectExpr("user AS follower").distinct()
        second = folded.join(middles, "follower", "left_semi").toDF("y", "z", "n_second")
        first = folded.toDF("x", "y", "n_first").repartition(path_parts(edges), "x")
        hops = first.join(F.broadcast(second), "y").selectExpr("x", "z", "n_first * n_second AS copies")
        hops = hops if keep_degenerate else hops.where("x <> z")
        return hops.groupBy("z", "x").agg(F.expr("sum(copies) AS n_paths"))
    return _joined_hops(edges, keep_degenerate=keep_degenerate).selectExpr("z", "x", "copies AS n_paths")


def path_parts(edges: DataFrame) -> int:
    """Into how many parts to deal the two-paths of ``edges``: one for each ``PART_PATHS``."""
    return 1 + (two_path_count(edges).first().n_paths // PART_PATHS)


def _joined_hops(
    edges: DataFrame,
    strategy: str = "auto",
    keep_degenerate: bool = False,
    cell_rows: int = GRID_ROWS,
    limit: int = HOT_KEYS,
    broadcast_edges: int = BROADCAST_EDGES,
) -> DataFrame:
    """``(x, y, z, copies)``: the two-paths, folded; see ``two_paths``."""
    folded = weighted_edges(edges)
    resolved = resolve(strategy, edges, folded, broadcast_edges)
    weighted = sliced(folded, "n_edges", SLICE_COPIES)
    columns = ("follower", "user", "slice", "n_edges")
    first = weighted.select(*columns).toDF("x", "y", "slice", "n_first")
    second = weighted.select(*columns).toDF("y", "z", "slice", "n_second")
    keys = ["y"]
    if resolved == "broadcast":
        first, second = first.drop("slice"), second.drop("slice")
    else:
        hubs = _middle_degrees(weighted)
        n_rows, n_columns = cells("n_in", cell_rows), cells("n_out", cell_rows)
        first = looked_up(first, ["y"], hubs, "degree", limit, cell_rows).selectExpr(
            "x", "y", "n_first", f"{cell_of('x, slice', n_rows)} AS row", f"{every_cell(n_columns)} AS column"
        )
        second = looked_up(second, ["y"], hubs, "degree", limit, cell_rows).selectExpr(
            "y", "z", "n_second", f"{every_cell(n_rows)} AS row", f"{cell_of('z, slice', n_columns)} AS column"
        )
        keys += ["row", "column"]
    joined = first.join(hinted(second, resolved), keys)
    if not keep_degenerate:
        joined = joined.where("x <> z")
    return joined.selectExpr("x", "y", "z", "n_first * n_second AS copies")


def two_path_count(edges: DataFrame | Graph, keep_degenerate: bool = False) -> DataFrame:
    """One row ``n_paths``: how many rows ``two_paths`` has, without listing them.

    In-edges times out-edges, summed over the middle nodes, less the paths that
    go back to their start. Aggregations only, so hubs need no care.
    """
    table = graph_of(edges).pairs
    totals = (
        table.selectExpr("stack(2, a, fwd + loops, bwd + loops, b, bwd, fwd) AS (node, n_out, n_in)")
        .groupBy("node")
        .agg(F.expr("sum(n_in) * sum(n_out) AS n_paths"))
        .agg(F.expr("sum(n_paths) AS n_paths"))
    )
    if not keep_degenerate:
        returning = table.agg(F.expr("-sum(2 * fwd * bwd + loops * loops) AS n_paths"))
        totals = totals.unionByName(returning)
    return totals.agg(F.expr("coalesce(sum(n_paths), 0L) AS n_paths"))


def close_two_paths(paths: DataFrame, edges: DataFrame, how: str = "semi", limit: int = HOT_KEYS) -> DataFrame:
    """Rows ``(x, y, z)`` of a given two-path table that an edge z→x closes.

    ``semi`` keeps a closed path once per row of ``paths``; ``bag`` once more for
    each duplicate of the closing edge.

    A bitmap of the edges drops most paths that none closes where they are; the others are
    written once. The ends ``(z, x)`` of these and of edges are counted, in one combined
    aggregation. Paths between ends that very many share stay where they are and find
    them in a broadcast table; the others are shuffled once, and a key of that join has
    one row on the side of the ends.
    """
    if how not in ("semi", "bag"):
        raise ValueError(f"unknown closing {how!r}, expected 'semi' or 'bag'")
    paths = _candidates(paths.select("x", "y", "z"), edges)
    ends = closing_counts(paths, edges).where("n_edges > 0 AND n_paths > 0")
    closed = looked_up(paths.select("x", "y", "z"), ["z", "x"], ends, "n_paths", limit, how="inner")
    if how == "bag":
        return expand_copies(closed.selectExpr("x", "y", "z", "n_edges AS copies"))
    return closed.select("x", "y", "z")


def _candidates(paths: DataFrame, edges: DataFrame) -> DataFrame:
    """``paths`` without most of those that no edge closes, written once; as they are where a
    bitmap of the edges would be too full, or hash other types.
    """
    closing = weighted_edges(edges).toDF("z", "x", "n_edges")
    bits = bits_for(closing.count())
    if not bits or [paths.schema[c].dataType for c in "zx"] != [closing.schema[c].dataType for c in "zx"]:
        return paths
    kept = maybe_among(paths.where("z IS NOT NULL AND x IS NOT NULL"), ["z", "x"], key_bitmap(closing, ["z", "x"], bits), bits)
    return materialize(kept, "candidates")


def stored_path_count(path_ends: DataFrame, edges: DataFrame, how: str = "semi") -> DataFrame:
    """One row ``(closed_paths, triangles)`` for stored two-path ends ``(z, x)``: how many
    an edge z→x closes (``semi``), or how often (``bag``). ``triangles`` is the third part,
    which is exact where each cycle's three paths are stored.
    """
    if how not in ("semi", "bag"):
        raise ValueError(f"unknown closing {how!r}, expected 'semi' or 'bag'")
    times = "n_paths * n_edges" if how == "bag" else "n_paths"
    total = (
        closing_counts(path_ends, edges).where("n_edges > 0").agg(F.expr(f"coalesce(sum({times}), 0L) AS closed_paths"))
    )
    return total.selectExpr("closed_paths", f"{third('closed_paths')} AS triangles")


def bucketed_closing_counts(path_ends: DataFrame, edges: DataFrame) -> DataFrame:
    """``closing_counts`` of the closed pairs only, for ends that are stored in buckets by
    ``(z, x)``: they are counted and joined where they are, and only the edges, folded
    before, are shuffled to them. A pair is one row on both sides of the join.
    """
    ends = path_ends.groupBy("z", "x").agg(F.expr(f"sum({_times(path_ends)}) AS n_paths"))
    closing = weighted_edges(edges).toDF("z", "x", "n_edges")
    return ends.join(closing, ["z", "x"]).select("z", "x", "n_edges", "n_paths")


def closing_counts(path_ends: DataFrame, edges: DataFrame) -> DataFrame:
    """``(z, x, n_edges, n_paths)``: edges z→x and two-paths from x to z, per pair.

    Both sources are tagged and counted in one aggregation. ``path_ends`` needs
    only the columns ``z, x``; a column ``n_paths`` says how many paths a row stands for. The
    closed two-paths are the sum of ``n_paths`` where ``n_edges > 0``.
    """
    tagged = edges.selectExpr("follower AS z", "user AS x", "1L AS n_edges", "0L AS n_paths").unionByName(
        path_ends.selectExpr("z", "x", "0L AS n_edges", f"{_times(path_ends)} AS n_paths")
    )
    return (
        tagged.where("z IS NOT NULL AND x IS NOT NULL")
        .groupBy("z", "x")
        .agg(*(F.expr(f"coalesce(sum({c}), 0L) AS {c}") for c in ("n_edges", "n_paths")))
    )


def _times(path_ends: DataFrame) -> str:
    return "n_paths" if "n_paths" in path_ends.columns else "1L"


def _middle_degrees(weighted: DataFrame) -> DataFrame:
    """``(y, n_in, n_out, degree)``: rows into, out of and at each middle node."""
    return (
        # True for every row; keeps n_edges, so that the shuffle below is shared.
        weighted.where("n_edges > 0")
        .selectExpr("stack(2, user, 1, 0, follower, 0, 1) AS (y, n_in, n_out)")
        .groupBy("y")
        .agg(F.expr("sum(n_in) AS n_in"), F.expr("sum(n_out) AS n_out"), F.expr("count(*) AS degree"))
    )
