"""Hot keys: bounded tables of them, lookups past them, and copies spread over tasks.

A key's row count is known before the join from a map-side combined count. The keys
above a share of the total are few whatever the data, so their table can be
broadcast; the other keys have few rows each, so a shuffle brings their numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Most rows of a broadcast hot-key table (a few LONGs each).
HOT_KEYS = 1_000_000

# Rows of one key that may meet in one join cell before the key is split.
CELL_ROWS = 1_000_000

# Copies of one row that one task writes, and the slice of a duplicate that keeps
# the product of two slices within it.
CHUNK_COPIES = 65_536
SLICE_COPIES = 256


def hot_keys(counts: DataFrame, weight: str, limit: int = HOT_KEYS, floor: int = 0) -> DataFrame:
    """Rows of ``counts`` whose ``weight`` is above ``max(floor, total / limit)``.

    Fewer than ``limit`` rows can exceed that share, so the result is safe to
    broadcast. On a graph of up to ``limit`` nodes every node can qualify.
    """
    bound = counts.select(F.expr(f"greatest(sum({weight}) / {limit}, double({floor}))")).scalar()
    return counts.where(F.col(weight) > bound)


def looked_up(
    rows: DataFrame,
    keys: list[str],
    table: DataFrame,
    weight: str,
    limit: int = HOT_KEYS,
    floor: int = 0,
    how: str = "left",
) -> DataFrame:
    """``rows`` with the columns of ``table``, which has one row for each of its ``keys``;
    ``weight`` bounds how many of ``rows`` have the key.

    Keys of more than ``floor`` rows get them exactly, others may get nulls (``left``)
    if ``floor`` is set. Hot keys come by broadcast and their rows stay where they are;
    only the rows of other keys, at most a ``limit``-th of all for each, are shuffled.
    """
    found = [c for c in table.columns if c not in keys]
    hot = F.broadcast(hot_keys(table, weight, limit, floor).withColumn("is_hot", F.lit(True)))
    marked = rows.join(hot, keys, "left")
    columns = [*rows.columns, *found]
    cold = table.where(f"{weight} > {floor}") if floor else table
    others = marked.where("is_hot IS NULL").select(rows.columns).join(cold, keys, how)
    return marked.where("is_hot").select(columns).unionByName(others.select(columns))


def sliced(rows: DataFrame, copies: str, size: int) -> DataFrame:
    """Rows with more than ``size`` copies as several rows of at most ``size``
    copies, numbered by a new column ``slice``.
    """
    kept = [c for c in rows.columns if c != copies]
    return rows.selectExpr("*", f"explode(sequence(0L, ({copies} - 1) div {size})) AS slice").selectExpr(
        *kept, "slice", f"least({size}L, {copies} - slice * {size}) AS {copies}"
    )


def repeated(rows: DataFrame, *columns: str) -> DataFrame:
    """``columns`` of each row as often as its column ``copies`` says."""
    each = "explode(if(copies = 1, array(1), sequence(1, int(copies)))) AS copy"
    return rows.selectExpr(*columns, each).drop("copy")


def expand_copies(rows: DataFrame, chunk: int = CHUNK_COPIES) -> DataFrame:
    """Each row as often as its column ``copies`` says, without that column.

    Rows of up to ``chunk`` copies are multiplied out where they are. Only rows with
    more are shuffled, while still compact, as several, so that no task writes all
    copies of one row. ``rows`` is read for each of the two, so that one which is dear to
    make is better written first.
    """
    columns = [c for c in rows.columns if c != "copies"]
    few, many = rows.where(f"copies <= {chunk}"), rows.where(f"copies > {chunk}")
    spread = sliced(many, "copies", chunk).repartition(*columns, "slice")
    return repeated(few, *columns).unionByName(repeated(spread, *columns))
