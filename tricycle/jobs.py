"""The batch programs: follower counts and triangle counts of an edge file, and
triangle counts from stored two-paths.

    spark-submit run.py follower-count EDGES OUTPUT [--nodes NODES] [--max-id N]
    spark-submit run.py triangle-count EDGES [--semantics S] [--strategy J] [--max-id N]

    spark-submit run.py stored-count EDGES --paths PATHS [--closing semi|bag]

``--max-id -1`` keeps every edge. ``--explain`` prints the plan of the result and
``--metrics`` how many rows it had, and of a triangle count also its wedges, closing hits and
largest join cell, observed in the pass that makes it. All run in whatever session Spark is
given.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from tricycle.operators import (
    SEMANTICS,
    follower_count,
    follower_count_all,
    induced_subgraph,
    stored_path_count,
    triangle_count,
)
from tricycle.plans import STRATEGIES, RunCounters, explain_text
from tricycle.sources import read_edges, read_nodes, read_two_paths, write_counts
from tricycle.sources.readers import MODES
from tricycle.sources.writers import FORMATS


def _max_id(text: str) -> int | None:
    return None if int(text) == -1 else int(text)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tricycle")
    jobs = top.add_subparsers(dest="job", required=True)
    common = argparse.ArgumentParser(add_help=False)
    common.add_argument("edges", help="header-less text file or folder, follower,user per line")
    common.add_argument("--max-id", type=_max_id, default=None, help="keep edges with both ids up to this")
    common.add_argument("--read-mode", default="PERMISSIVE", choices=MODES)
    common.add_argument("--explain", action="store_true", help="print the plan")
    common.add_argument("--metrics", action="store_true", help="print the number of result rows and of steps")

    counts = jobs.add_parser("follower-count", parents=[common])
    counts.add_argument("output")
    counts.add_argument("--nodes", help="count these nodes, 0 included, most followed first")
    counts.add_argument("--sort", action="store_true", help="most followed first")
    counts.add_argument("--format", default="csv", choices=FORMATS)
    counts.add_argument("--sep", default=",")
    counts.add_argument("--overwrite", action="store_true")

    stored = jobs.add_parser("stored-count", parents=[common])
    stored.add_argument("--paths", required=True, help="stored two-paths, z,x per line")
    stored.add_argument("--closing", default="semi", choices=["semi", "bag"])

    triangles = jobs.add_parser("triangle-count", parents=[common])
    triangles.add_argument("--semantics", default="bag", choices=SEMANTICS)
    triangles.add_argument("--strategy", default="auto", choices=STRATEGIES)
    return top


def run(spark: SparkSession, argv: list[str]) -> DataFrame:
    """Run one job; returns the counts or the one-row triangle count."""
    args = parser().parse_args(argv)
    edges = induced_subgraph(read_edges(spark, args.edges, args.read_mode), args.max_id)
    counters = RunCounters() if args.metrics else None
    if args.job != "follower-count":
        if args.job == "triangle-count":
            total = triangle_count(edges, args.semantics, args.strategy, counters=counters)
        else:
            total = stored_path_count(read_two_paths(spark, args.paths, args.read_mode), edges, args.closing)
        return _reported(total, args, counters, lambda df: df.collect())
    if args.nodes:
        counts = follower_count_all(read_nodes(spark, args.nodes, args.read_mode), edges)
    else:
        counts = follower_count(edges, sort=args.sort)
    mode = "overwrite" if args.overwrite else "errorifexists"
    return _reported(
        counts, args, counters, lambda df: write_counts(df, args.output, args.format, args.sep, mode), act=True
    )


def _reported(
    df: DataFrame, args: argparse.Namespace, counters: RunCounters | None, action, act: bool = False
) -> DataFrame:
    """Run the action if the job has one or metrics are asked for; print what is asked for."""
    if args.explain:
        print(explain_text(df))
    if counters is None:
        if act:
            action(df)
        return df
    action(counters.done(df))
    print(counters.values)
    return df
