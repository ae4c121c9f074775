"""Result sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FORMATS = ("csv", "text", "parquet")


def write_counts(
    df: DataFrame,
    path: str,
    format: str = "csv",
    sep: str = ",",
    mode: str = "errorifexists",
    order_by: str | None = None,
) -> None:
    """Write a result table.

    ``text`` joins the columns with ``sep`` (any length) into one line per row;
    a NULL becomes an empty field. An existing ``path`` is an error unless
    ``mode='overwrite'``. ``order_by`` sorts within each part file, without a shuffle.
    """
    if format not in FORMATS:
        raise ValueError(f"unknown format {format!r}, expected one of {FORMATS}")
    if order_by is not None:
        df = df.sortWithinPartitions(order_by)
    if format == "parquet":
        df.write.mode(mode).parquet(path)
    elif format == "csv":
        df.write.mode(mode).option("sep", sep).option("header", "false").csv(path)
    else:
        fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]
        df.select(F.concat_ws(sep, *fields).alias("value")).write.mode(mode).text(path)


def write_two_paths(
    paths: DataFrame, path: str, mode: str = "errorifexists", buckets: int | None = None
) -> None:
    """Keep a two-path table as text lines ``z,x``: a line equals its closing edge.

    With ``buckets`` the ends are kept as Parquet in so many buckets by ``(z, x)``, so that
    closing them later shuffles the edges only. Read them with the same number of buckets.
    They are shuffled once here, so that a bucket is one file.

    Where ``paths`` has a column ``n_paths`` (``two_path_ends``), it is kept as a third
    field or column: how many paths the row stands for. Such ends are read ``counted``.
    """
    ends = paths.select("z", "x", *(c for c in paths.columns if c == "n_paths"))
    if buckets is None:
        write_counts(ends, path, "csv", mode=mode)
        return
    ends = ends.repartition(buckets, "z", "x")
    writer = ends.write.mode(mode).format("parquet").bucketBy(buckets, "z", "x").sortBy("z", "x")
    writer.option("path", path).saveAsTable(f"two_paths_{uuid.uuid4().hex}")
