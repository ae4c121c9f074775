"""Edge and node sources on any Hadoop-compatible path.

All text readers follow one rule. A line is split at every separator, fields are
trimmed of spaces, tabs and carriage returns, and there is no quoting. Blank lines are
skipped, fields beyond those needed are ignored, and a field that is missing or no LONG
is bad: NULL under ``PERMISSIVE``, the line left out under ``DROPMALFORMED``, an error
under ``FAILFAST``, also where a query reads only the good fields.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EDGE_SCHEMA = "follower LONG, user LONG"
NODE_SCHEMA = "user LONG"
MODES = ("PERMISSIVE", "DROPMALFORMED", "FAILFAST")


def edge_table(df: DataFrame, follower: Column | str, user: Column | str) -> DataFrame:
    """Edges ``(follower LONG, user LONG)`` out of two columns of any table."""
    follower, user = (F.col(c) if isinstance(c, str) else c for c in (follower, user))
    return df.select(follower.cast("long").alias("follower"), user.cast("long").alias("user"))


def parsed_lines(lines: DataFrame, names: tuple[str, ...], mode: str = "PERMISSIVE", sep: str = ",") -> DataFrame:
    """LONG columns ``names`` out of the text column ``value``, by the rule above."""
    if mode.upper() not in MODES:
        raise ValueError(f"unknown read mode {mode!r}, expected one of {MODES}")
    value = F.col("value")
    # One escaped character is split at as it is; any other pattern is compiled for each line.
    quoted = "\\Q" + sep.replace("\\E", "\\E\\\\E\\Q") + "\\E"
    one = len(sep) == 1 and sep.isascii() and not sep.isalnum()
    fields = F.split(value, "\\" + sep if one else quoted, -1)
    columns = [F.btrim(F.get(fields, F.lit(k)), F.lit(" \t\r")).try_cast("long") for k in range(len(names))]
    lines = lines.where(F.btrim(value, F.lit(" \t\r")) != "")
    if mode.upper() != "PERMISSIVE":
        good = F.lit(True)
        for column in columns:
            good = good & column.isNotNull()
        bad = F.raise_error(F.concat(F.lit("malformed line: "), value)).cast("boolean")
        lines = lines.where(F.when(good, True).otherwise(bad if mode.upper() == "FAILFAST" else F.lit(False)))
    return lines.select(*(column.alias(name) for column, name in zip(columns, names, strict=True)))


def read_edges(spark: SparkSession, path: str, mode: str = "PERMISSIVE", sep: str = ",") -> DataFrame:
    """Header-less text edges ``follower<sep>user``."""
    return parsed_lines(spark.read.text(path), ("follower", "user"), mode, sep)


def read_edge_lines(spark: SparkSession, path: str, sep: str = ",", mode: str = "PERMISSIVE") -> DataFrame:
    """Edges split out of raw text lines: the same rows as ``read_edges``."""
    return read_edges(spark, path, mode, sep)


def read_nodes(spark: SparkSession, path: str, mode: str = "PERMISSIVE") -> DataFrame:
    """Header-less node file: the first field of each line."""
    return parsed_lines(spark.read.text(path), ("user",), mode)


def read_two_paths(
    spark: SparkSession, path: str, mode: str = "PERMISSIVE", buckets: int | None = None, counted: bool = False
) -> DataFrame:
    """Stored two-path ends ``(z, x)``, in text form ``z,x`` per line, or with ``buckets`` in
    so many Parquet buckets. Those become a table of the session's catalog. Ends that were
    written ``counted`` have their number of paths, ``n_paths``, besides.
    """
    columns = ("z", "x", "n_paths") if counted else ("z", "x")
    if buckets is not None:
        name = f"two_paths_{uuid.uuid4().hex}"
        location = path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {name} ({', '.join(f'{c} LONG' for c in columns)}) USING parquet CLUSTERED BY (z, x) SORTED BY (z, x)"
            f" INTO {int(buckets)} BUCKETS LOCATION '{location}'"
        )
        return spark.table(name)
    return parsed_lines(spark.read.text(path), columns, mode)
