"""Closed two-paths by three plain joins of the edges, for graphs with few two-paths."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tricycle.plans.report import RunCounters
from tricycle.plans.strategy import hinted


def joined_paths(weighted: DataFrame, semantics: str, strategy: str, counters: RunCounters | None = None) -> DataFrame:
    """``(x, y, z, copies)`` of the closed two-paths, as ``triangle_count`` defines them;
    under ``cycle`` each of the three views of a cycle once. ``counters`` gets the rows of
    two-paths (``wedges``) and of closed ones (``closing_hits``).
    """
    if semantics == "cycle":
        weighted = weighted.where("follower <> user").select("follower", "user").distinct()
        weighted = weighted.withColumn("n_edges", F.lit(1).cast("long"))
    first, second = weighted.toDF("x", "y", "n_first"), weighted.toDF("y", "z", "n_second")
    paths = first.join(hinted(second, strategy), "y")
    if semantics != "walk":
        paths = paths.where("x <> z")
    if counters is not None:
        paths = counters.on(paths, wedges="count(*)")
    closing = weighted.toDF("z", "x", "n_closing")
    if semantics in ("bag", "cycle"):
        closed = paths.join(hinted(closing, strategy), ["z", "x"])
        copies = "n_first * n_second * n_closing"
    else:
        closed = paths.join(hinted(closing.drop("n_closing"), strategy), ["z", "x"], "left_semi")
        copies = "n_first * n_second"
    if counters is not None:
        closed = counters.on(closed, closing_hits="count(*)")
    return closed.selectExpr("x", "y", "z", f"{copies} AS copies")
