"""Places of rows in a global order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tricycle.plans.shared import materialize

# Bits of ``monotonically_increasing_id`` that count within a partition.
_WITHIN = 33


def numbered(rows: DataFrame, *order: Column | str, name: str = "place", copies: str | None = None) -> DataFrame:
    """``rows`` with their places in the given order, 0, 1, ... in the LONG column ``name``.

    Rows are range-partitioned by ``order`` and sorted within partitions, so that the place
    of a row is the number of rows in earlier partitions, a table with a row for each
    partition, and its place in its own. The sorted rows are written to the shared folder
    once, so places hold whatever is read again. With ``copies`` each row is repeated, in
    place, as often as that column says (0: never), which is dropped; rows that are equal in
    ``order`` share a partition, so a row that is there very often is better sent as one
    row with its copies, cut into slices.

    Without ``order`` the rows keep the order that they have.
    """
    columns = [c for c in rows.columns if c != copies]
    if order:
        rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    if copies is not None:
        rows = rows.where(f"{copies} > 0").selectExpr(*columns, f"explode(sequence(1, int({copies}))) AS __copy")
    rows = rows.select(*columns, F.monotonically_increasing_id().alias("__at"))
    rows = materialize(rows, "ordered").withColumn("__part", F.shiftright("__at", _WITHIN))
    parts = rows.groupBy("__part").count()
    before = F.sum("count").over(Window.orderBy("__part")) - F.col("count")
    parts = F.broadcast(parts.select("__part", before.alias("__before")))
    within = F.col("__at").bitwiseAND(F.lit((1 << _WITHIN) - 1))
    return rows.join(parts, "__part").select(*columns, (within + F.col("__before")).alias(name))
