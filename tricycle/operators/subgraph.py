"""Edge-table preparation."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def induced_subgraph(edges: DataFrame, max_id: int | None = None) -> DataFrame:
    """Edges with both ids ``<= max_id``; ``None`` keeps every edge."""
    if max_id is None:
        return edges
    return edges.where((F.col("follower") <= max_id) & (F.col("user") <= max_id))


def prepare_edges(
    edges: DataFrame, max_id: int | None = None, partitions: int | None = None, cache: bool = False
) -> DataFrame:
    """Filter, then optionally spread, then optionally cache.

    The filter comes first so that it reaches the scan and the cache holds only
    the kept edges. ``partitions`` spreads rows evenly instead of by follower,
    so that a hub does not fill one partition; the operators pre-aggregate by
    node pair and gain nothing from a partitioning by follower.
    """
    kept = induced_subgraph(edges, max_id)
    if partitions is not None:
        kept = kept.repartition(partitions)
    return kept.persist(StorageLevel.MEMORY_AND_DISK) if cache else kept
