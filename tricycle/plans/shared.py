"""Tables in a folder that every executor can reach."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, or where it is unset a folder in the session's
    warehouse. On a cluster a warehouse on a machine's own disk is refused.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        warehouse, master = spark.conf.get("spark.sql.warehouse.dir"), spark.sparkContext.master
        folder = _fallback(warehouse, master)
    return f"{folder.rstrip('/')}/{spark.sparkContext.applicationId}"


def _fallback(warehouse: str, master: str) -> str:
    one_machine = master == "local" or master.startswith("local[")
    if not one_machine and (warehouse.startswith("file:") or "://" not in warehouse):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{warehouse.rstrip('/')}/shared"


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, under a folder of this application."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: it is made once, and
    neither its lineage nor an executor that is lost later matters to a reader.
    """
    path = shared_path(df.sparkSession, name)
    # Nothing looks for the marker file of a finished job: the write returns or fails.
    df.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
