"""Command line for spark-submit; see ``tricycle.jobs``."""

import sys

from pyspark.sql import SparkSession

from tricycle.jobs import run

if __name__ == "__main__":
    spark = SparkSession.builder.appName("tricycle").getOrCreate()
    result = run(spark, sys.argv[1:])
    if sys.argv[1:2] != ["follower-count"]:
        row = result.first()
        print(f"closed paths: {row.closed_paths}, triangles: {row.triangles}")
    spark.stop()
