"""Registered queries and their SQL equivalents.

Each operator runs on two graphs that Spark derives from the given tables:
``events`` (user_id → the k of its JSON props; dense, many duplicates) and
``orders`` (the customer of an order → the customer of the next order; sparse).
Nodes are the customers.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable
from functools import partial
from types import ModuleType

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import tricycle as tc
from tricycle.plans import numbered, shared_path

# Id filter of the filtered queries: it leaves about half of each graph.
MAX_ID = {"events": 49, "orders": 700}
# Sizes that split even small lists and joins, for the queries named ``_split``.
SMALL = {"cell_rows": 50, "limit": 60}
RANKED = {"plain_paths": 0}  # cycles from nodes of lowest degree, however small the graph
SMALL_BLOCK = 7
BUCKETS = 8  # of stored two-paths, at least
TEXT_SEP = "\t\t :"  # key/value separator of the text count sink


# ---------------------------------------------------------------- graphs


def events_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.selectExpr("user_id AS follower", "CAST(get_json_object(props, '$.k') AS LONG) AS user")


def orders_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    this = orders.selectExpr("o_custkey AS follower", "o_orderkey + 1 AS next_order")
    following = orders.selectExpr("o_orderkey AS next_order", "o_custkey AS user")
    return this.join(following, "next_order").select("follower", "user")


def customer_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/customer.parquet").selectExpr("c_custkey AS user")


GRAPHS = {"events": events_edges, "orders": orders_edges}

SQL_EDGES = {
    "events": """SELECT user_id AS follower,
        CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) AS "user" FROM events""",
    "orders": """SELECT a.o_custkey AS follower, b.o_custkey AS "user"
        FROM orders a JOIN orders b ON b.o_orderkey = a.o_orderkey + 1""",
}


# ---------------------------------------------------------------- queries on one graph


def _printable(lists: DataFrame) -> DataFrame:
    return lists.selectExpr(
        "follower", "block", "size(followees) AS n_followees", "array_join(followees, ',') AS followees"
    )


def _counts_text(spark: SparkSession, edges: DataFrame) -> DataFrame:
    path = shared_path(spark, "counts-text")
    tc.write_counts(tc.follower_count(edges), path, "text", TEXT_SEP)
    fields = "split(value, '\\t\\t :')"
    return spark.read.text(path).selectExpr(
        f"CAST({fields}[0] AS LONG) AS user", f"CAST({fields}[1] AS LONG) AS n_followers"
    )


def _counts_csv(spark: SparkSession, edges: DataFrame) -> DataFrame:
    path = shared_path(spark, "counts-csv")
    tc.write_counts(edges.select("user", "follower"), path, "csv")  # overwritten by the counts
    tc.write_counts(tc.follower_count(edges), path, "csv", mode="overwrite")
    return spark.read.schema("user LONG, n_followers LONG").csv(path)


def _counts_parquet(spark: SparkSession, edges: DataFrame) -> DataFrame:
    path = shared_path(spark, "counts-parquet")
    tc.write_counts(tc.follower_count(edges), path, "parquet")
    return spark.read.parquet(path)


def _edges_csv(spark: SparkSession, edges: DataFrame) -> DataFrame:
    path = shared_path(spark, "edges-csv")
    tc.write_counts(edges.select("follower", "user"), path, "csv")
    return tc.read_edges(spark, path, mode="FAILFAST")


def _edges_lines(spark: SparkSession, edges: DataFrame) -> DataFrame:
    path = shared_path(spark, "edges-text")
    tc.write_counts(edges.select("follower", "user"), path, "text")
    return tc.read_edge_lines(spark, path)


def _stored_two_paths(spark: SparkSession, edges: DataFrame) -> DataFrame:
    path = shared_path(spark, "two-paths")
    tc.write_two_paths(tc.two_path_ends(edges), path)
    return tc.closing_counts(tc.read_two_paths(spark, path, counted=True), edges).where("n_edges > 0 AND n_paths > 0")


def _bucketed_two_paths(spark: SparkSession, edges: DataFrame) -> DataFrame:
    path = shared_path(spark, "two-paths")
    buckets = max(BUCKETS, tc.path_parts(edges))
    tc.write_two_paths(tc.two_path_ends(edges), path, buckets=buckets)
    return tc.bucketed_closing_counts(tc.read_two_paths(spark, path, buckets=buckets, counted=True), edges)


def _prepared_counts(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """Two counts of one prepared graph, one by plain joins and one by degree."""
    graph = tc.prepare_graph(edges)
    bag = tc.triangle_count(graph, "bag").selectExpr("'bag' AS semantics", "*")
    return bag.unionByName(tc.triangle_count(graph, "semi", plain_paths=0).selectExpr("'semi' AS semantics", "*"))


def _closed_given_paths(spark: SparkSession, edges: DataFrame, how: str) -> DataFrame:
    return tc.close_two_paths(tc.two_paths(edges), edges, how)


def _observed_count(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """The metrics that writing the counts observes."""
    total = F.sum("n_followers").alias("n_edges"), F.count(F.lit(1)).alias("n_users")
    counts, observation = tc.with_metrics(tc.follower_count(edges), "follower_count", *total)
    counts.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([observation.get], "n_edges LONG, n_users LONG")


def _observed_steps(spark: SparkSession, edges: DataFrame, semantics: str = "bag") -> DataFrame:
    """What a triangle count by degree observes of its steps, with its result."""
    counters = tc.RunCounters()
    total = counters.done(tc.triangle_count(edges, semantics, "merge", counters=counters, **RANKED)).first()
    values = counters.values
    steps = [values[name] or 0 for name in ("wedges", "closing_hits", "largest_cell")]
    names = "closed_paths LONG, wedges LONG, closing_hits LONG, largest_cell LONG"
    return spark.createDataFrame([(total.closed_paths, *steps)], names)


def _with_place(rows: DataFrame) -> DataFrame:
    """Rows with their ``place`` in the order that the table has, from 1."""
    return numbered(rows).withColumn("place", F.col("place") + 1)


def _stored_count(spark: SparkSession, edges: DataFrame, how: str) -> DataFrame:
    path = shared_path(spark, "two-paths")
    tc.write_two_paths(tc.two_path_ends(edges), path)
    return tc.stored_path_count(tc.read_two_paths(spark, path, "FAILFAST", counted=True), edges, how)


ON_EDGES: dict[str, Callable[[SparkSession, DataFrame], DataFrame]] = {
    "edges": lambda s, e: e,
    "edges_csv": _edges_csv,
    "edges_lines": _edges_lines,
    "prepared_edges": lambda s, e: tc.prepare_edges(e, partitions=16),
    "follower_count": lambda s, e: tc.follower_count(e),
    "follower_count_sorted": lambda s, e: _with_place(tc.follower_count(e, sort=True)),
    "follower_count_observed": _observed_count,
    "counts_csv": _counts_csv,
    "counts_text": _counts_text,
    "counts_parquet": _counts_parquet,
    "adjacency": lambda s, e: _printable(tc.adjacency(e)),
    "adjacency_edges": lambda s, e: tc.adjacency_edges(tc.adjacency(e)),
    "two_paths": lambda s, e: tc.two_paths(e),
    "two_paths_merge": lambda s, e: tc.two_paths(e, strategy="merge"),
    "two_paths_broadcast": lambda s, e: tc.two_paths(e, strategy="broadcast"),
    "two_paths_degenerate": lambda s, e: tc.two_paths(e, keep_degenerate=True),
    "adjacency_blocks": lambda s, e: _printable(tc.adjacency(e, SMALL_BLOCK, limit=60)),
    "two_paths_split": lambda s, e: tc.two_paths(e, **SMALL),
    "closed_paths_bag_split": lambda s, e: tc.closed_paths_bag(e, block_rows=5, chunk=3, **SMALL, **RANKED),
    "cycle_list_split": lambda s, e: tc.cycle_list(e, block_rows=5, **SMALL, **RANKED),
    "triangle_count_split": lambda s, e: tc.triangle_count(e, "bag", limit=60, block_rows=5, **RANKED),
    "given_paths_closed_split": lambda s, e: tc.close_two_paths(tc.two_paths(e), e, "bag", limit=60),
    "stored_two_paths_count": partial(_stored_count, how="semi"),
    "stored_two_paths_count_bag": partial(_stored_count, how="bag"),
    "stored_two_paths_bucketed": _bucketed_two_paths,
    "prepared_graph_counts": _prepared_counts,
    "two_path_count": lambda s, e: tc.two_path_count(e),
    "stored_two_paths_closed": _stored_two_paths,
    "given_paths_closed_semi": partial(_closed_given_paths, how="semi"),
    "given_paths_closed_bag": partial(_closed_given_paths, how="bag"),
    "closed_paths_bag": lambda s, e: tc.closed_paths_bag(e),
    "closed_paths_bag_merge": lambda s, e: tc.closed_paths_bag(e, strategy="merge"),
    "closed_paths_bag_broadcast": lambda s, e: tc.closed_paths_bag(e, strategy="broadcast"),
    "closed_paths_semi": lambda s, e: tc.closed_paths_semi(e),
    "closed_walks": lambda s, e: tc.closed_paths_semi(e, keep_degenerate=True),
    "triangle_count_bag": lambda s, e: tc.triangle_count(e, "bag"),
    "triangle_count_semi": lambda s, e: tc.triangle_count(e, "semi"),
    "triangle_count_walk": lambda s, e: tc.triangle_count(e, "walk"),
    "triangle_count_cycle": lambda s, e: tc.triangle_count(e, "cycle"),
    "triangle_count_merge": lambda s, e: tc.triangle_count(e, "bag", strategy="merge"),
    "triangle_count_broadcast": lambda s, e: tc.triangle_count(e, "bag", strategy="broadcast"),
    "triangle_count_bitmap": lambda s, e: tc.triangle_count(e, "bag", strategy="merge", **RANKED),
    "triangle_count_observed": _observed_steps,
    "triangle_count_semi_broadcast": lambda s, e: tc.triangle_count(e, "semi", strategy="broadcast"),
    "cycle_list": lambda s, e: tc.cycle_list(e),
}


def _follower_count_all(spark: SparkSession, sf_dir: str, graph: str) -> DataFrame:
    return _with_place(tc.follower_count_all(customer_nodes(spark, sf_dir), GRAPHS[graph](spark, sf_dir)))


FILTERED_BY_ID: dict[str, Callable[[DataFrame], DataFrame]] = {
    "induced_subgraph": lambda e: e,
    "follower_count_filtered": tc.follower_count,
    "triangle_count_max_id": lambda e: tc.triangle_count(e, "bag"),
}


def _filtered(spark: SparkSession, sf_dir: str, graph: str, operator: Callable[[DataFrame], DataFrame]) -> DataFrame:
    return operator(tc.induced_subgraph(GRAPHS[graph](spark, sf_dir), MAX_ID[graph]))


def _nodes_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "nodes-csv")
    tc.write_counts(customer_nodes(spark, sf_dir), path, "csv")
    return tc.read_nodes(spark, path)


def _edges_malformed(spark: SparkSession, sf_dir: str, read: Callable[..., DataFrame]) -> DataFrame:
    """Lines with a bad or no second field, spaces, quotes, further fields, an id
    beyond LONG, and blank lines.
    """
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    lines = events.selectExpr(
        "explode(array(concat(event_type, ',', user_id), string(user_id), concat(' ', user_id, ',\t', event_id, ',9'),"
        " concat('\"', user_id, '\",', event_id), concat(user_id, ',99999999999999999999'), ' ', '')) AS value"
    )
    path = shared_path(spark, "edges-malformed")
    tc.write_counts(lines, path, "text")
    return read(spark, path)


# ---------------------------------------------------------------- SQL equivalents

NO_LOOPS = 's AS (SELECT DISTINCT follower, "user" FROM e WHERE follower <> "user")'
DISTINCT_EDGES = 'd AS (SELECT DISTINCT follower, "user" FROM e)'
PATHS = 'p AS (SELECT a.follower AS x, a."user" AS y, b."user" AS z FROM e a JOIN e b ON b.follower = a."user")'
SEMI = 'EXISTS (SELECT 1 FROM d WHERE d.follower = p.z AND d."user" = p.x)'
COUNT = 'SELECT "user", COUNT(*) AS n_followers FROM e GROUP BY "user"'
BAG_JOIN = 'FROM p JOIN e c ON c.follower = p.z AND c."user" = p.x WHERE p.x <> p.z'
CYCLES = """FROM s a JOIN s b ON b.follower = a."user" JOIN s c ON c.follower = b."user" AND c."user" = a.follower
    WHERE a.follower < a."user" AND a.follower < b."user" """
TOTALS = "SELECT CAST(n AS BIGINT) AS closed_paths, CAST(n // 3 AS BIGINT) AS triangles FROM ({})"

BAG_LIST = f"WITH e AS ({{edges}}), {PATHS} SELECT p.x, p.y, p.z {BAG_JOIN}"
SEMI_LIST = f"WITH e AS ({{edges}}), {PATHS}, {DISTINCT_EDGES} SELECT x, y, z FROM p WHERE x <> z AND {SEMI}"
BAG_TOTAL = f"WITH e AS ({{edges}}), {PATHS} " + TOTALS.format(f"SELECT COUNT(*) AS n {BAG_JOIN}")
SEMI_TOTAL = f"WITH e AS ({{edges}}), {PATHS}, {DISTINCT_EDGES} " + TOTALS.format(
    f"SELECT COUNT(*) AS n FROM p WHERE x <> z AND {SEMI}"
)
PATH_LIST = f"WITH e AS ({{edges}}), {PATHS} SELECT x, y, z FROM p WHERE x <> z"
EDGE_LIST = 'WITH e AS ({edges}) SELECT follower, "user" FROM e'
FILTERED = 'WITH g AS ({edges}), e AS (SELECT * FROM g WHERE follower <= {max_id} AND "user" <= {max_id})'
PLACE = 'row_number() OVER (ORDER BY n_followers DESC, "user" NULLS FIRST)'
BLOCKS = """WITH e AS ({{edges}}), r AS (SELECT *, (row_number() OVER (PARTITION BY follower ORDER BY "user") - 1)
        // {size} AS block FROM e WHERE follower IS NOT NULL AND "user" IS NOT NULL)
    SELECT follower, CAST(block AS INTEGER) AS block, CAST(COUNT(*) AS INTEGER) AS n_followees,
        array_to_string(list_sort(list("user")), ',') AS followees FROM r GROUP BY follower, block"""

SQL_ON_EDGES = {
    "edges": EDGE_LIST,
    "edges_csv": EDGE_LIST,
    "edges_lines": EDGE_LIST,
    "prepared_edges": EDGE_LIST,
    "follower_count": f"WITH e AS ({{edges}}) {COUNT}",
    "follower_count_sorted": f"WITH e AS ({{edges}}), n AS ({COUNT}) SELECT *, {PLACE} AS place FROM n",
    "follower_count_observed": 'WITH e AS ({edges}) SELECT COUNT(*) AS n_edges, COUNT(DISTINCT "user") AS n_users FROM e',
    "counts_csv": f"WITH e AS ({{edges}}) {COUNT}",
    "counts_text": f"WITH e AS ({{edges}}) {COUNT}",
    "counts_parquet": f"WITH e AS ({{edges}}) {COUNT}",
    "adjacency": BLOCKS.format(size=100_000),
    "adjacency_blocks": BLOCKS.format(size=SMALL_BLOCK),
    "two_paths_split": PATH_LIST,
    "closed_paths_bag_split": BAG_LIST,
    "triangle_count_split": BAG_TOTAL,
    "given_paths_closed_split": BAG_LIST,
    "stored_two_paths_count": SEMI_TOTAL,
    "stored_two_paths_count_bag": BAG_TOTAL,
    "adjacency_edges": EDGE_LIST,
    "two_paths": PATH_LIST,
    "two_paths_merge": PATH_LIST,
    "two_paths_broadcast": PATH_LIST,
    "two_paths_degenerate": f"WITH e AS ({{edges}}), {PATHS} SELECT x, y, z FROM p",
    "two_path_count": f"WITH e AS ({{edges}}), {PATHS} SELECT COUNT(*) AS n_paths FROM p WHERE x <> z",
    "stored_two_paths_closed": f"""WITH e AS ({{edges}}), {PATHS},
        k AS (SELECT z, x, COUNT(*) AS n_paths FROM p WHERE x <> z GROUP BY z, x),
        c AS (SELECT follower, "user", COUNT(*) AS n_edges FROM e GROUP BY follower, "user")
        SELECT k.z, k.x, c.n_edges, k.n_paths FROM k JOIN c ON c.follower = k.z AND c."user" = k.x""",
    "given_paths_closed_semi": SEMI_LIST,
    "given_paths_closed_bag": BAG_LIST,
    "closed_paths_bag": BAG_LIST,
    "closed_paths_bag_merge": BAG_LIST,
    "closed_paths_bag_broadcast": BAG_LIST,
    "closed_paths_semi": SEMI_LIST,
    "closed_walks": f"WITH e AS ({{edges}}), {PATHS}, {DISTINCT_EDGES} SELECT x, y, z FROM p WHERE {SEMI}",
    "triangle_count_bag": BAG_TOTAL,
    "triangle_count_semi": SEMI_TOTAL,
    "triangle_count_walk": f"WITH e AS ({{edges}}), {PATHS}, {DISTINCT_EDGES} "
    + TOTALS.format(f"SELECT COUNT(*) AS n FROM p WHERE {SEMI}"),
    "triangle_count_cycle": f"WITH e AS ({{edges}}), {NO_LOOPS} "
    + TOTALS.format(f"SELECT 3 * COUNT(*) AS n {CYCLES}"),
    "triangle_count_merge": BAG_TOTAL,
    "triangle_count_broadcast": BAG_TOTAL,
    "triangle_count_semi_broadcast": SEMI_TOTAL,
    "cycle_list": f"""WITH e AS ({{edges}}), {NO_LOOPS}
        SELECT a.follower AS x, b.follower AS y, c.follower AS z {CYCLES}""",
}
SQL_ON_EDGES["triangle_count_bitmap"] = BAG_TOTAL
# Wedges at the node of lowest degree; a cell is a whole list here, as none is above a block.
SQL_ON_EDGES["triangle_count_observed"] = f"""WITH e AS ({{edges}}), {PATHS},
    g AS (SELECT least(follower, "user") AS a, greatest(follower, "user") AS b, COUNT(*) FILTER (follower < "user") AS fwd,
        COUNT(*) FILTER (follower > "user") AS bwd FROM e WHERE follower <> "user" GROUP BY ALL),
    n AS (SELECT node, COUNT(*) AS degree FROM (SELECT unnest([a, b]) AS node FROM g) GROUP BY node),
    k AS (SELECT g.*, s.degree > t.degree AS swap FROM g JOIN n s ON s.node = a JOIN n t ON t.node = b),
    r AS (SELECT CASE WHEN swap THEN b ELSE a END AS u, CASE WHEN swap THEN a ELSE b END AS v,
        CASE WHEN swap THEN bwd ELSE fwd END AS uv, CASE WHEN swap THEN fwd ELSE bwd END AS vu FROM k),
    w AS (SELECT s.v AS a, t.v AS b, s.uv > 0 AND t.vu > 0 AS ab, t.uv > 0 AND s.vu > 0 AS ba
        FROM r s JOIN r t ON s.u = t.u AND s.v < t.v WHERE s.uv > 0 AND t.vu > 0 OR t.uv > 0 AND s.vu > 0),
    c AS (SELECT DISTINCT a, b FROM w JOIN g USING (a, b) WHERE fwd > 0 AND ab OR bwd > 0 AND ba),
    l AS (SELECT COUNT(*) AS cell FROM r GROUP BY u)
    SELECT CAST((SELECT COUNT(*) {BAG_JOIN}) AS BIGINT) AS closed_paths, CAST((SELECT COUNT(*) FROM w) AS BIGINT) AS wedges,
        CAST((SELECT COUNT(*) FROM c) AS BIGINT) AS closing_hits,
        CAST((SELECT coalesce(MAX(cell * cell), 0) FROM l) AS BIGINT) AS largest_cell"""
SQL_ON_EDGES["cycle_list_split"] = SQL_ON_EDGES["cycle_list"]
SQL_ON_EDGES["stored_two_paths_bucketed"] = SQL_ON_EDGES["stored_two_paths_closed"]
SQL_ON_EDGES["prepared_graph_counts"] = (
    f"SELECT 'bag' AS semantics, * FROM ({BAG_TOTAL}) UNION ALL SELECT 'semi' AS semantics, * FROM ({SEMI_TOTAL})"
)

SQL_FILTERED_BY_ID = {
    "induced_subgraph": FILTERED + ' SELECT follower, "user" FROM e',
    "follower_count_filtered": f"{FILTERED} {COUNT}",
    "triangle_count_max_id": f"{FILTERED}, {PATHS} " + TOTALS.format(f"SELECT COUNT(*) AS n {BAG_JOIN}"),
}


# ---------------------------------------------------------------- driver contract


def entry(spark: SparkSession, sf_dir: str = "/root/testdata/sf0.001") -> DataFrame:
    """Flagship query: directed triangles of the events graph, bag semantics."""
    return tc.triangle_count(events_edges(spark, sf_dir), "bag")


def graph_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One entry per operator and graph; each takes (spark, sf_dir)."""

    def on(operator, graph):
        return lambda spark, sf_dir: operator(spark, GRAPHS[graph](spark, sf_dir))

    found = {f"{name}_{graph}": on(operator, graph) for name, operator in ON_EDGES.items() for graph in GRAPHS}
    for graph in GRAPHS:
        found[f"follower_count_all_{graph}"] = partial(_follower_count_all, graph=graph)
        for name, operator in FILTERED_BY_ID.items():
            found[f"{name}_{graph}"] = partial(_filtered, graph=graph, operator=operator)
    found["nodes_csv"] = _nodes_csv
    found["edges_malformed"] = partial(_edges_malformed, read=tc.read_edges)
    found["edges_malformed_lines"] = partial(_edges_malformed, read=tc.read_edge_lines)
    return found


def graph_sql() -> dict[str, str]:
    """For each graph query the same result in SQL over the given tables."""
    found = {
        f"{name}_{graph}": sql.format(edges=SQL_EDGES[graph]) for name, sql in SQL_ON_EDGES.items() for graph in GRAPHS
    }
    for graph in GRAPHS:
        found[f"follower_count_all_{graph}"] = f"""WITH e AS ({SQL_EDGES[graph]}),
            n AS (SELECT c.c_custkey AS "user", COUNT(e."user") AS n_followers
            FROM customer c LEFT JOIN e ON e."user" = c.c_custkey GROUP BY c.c_custkey)
            SELECT *, {PLACE} AS place FROM n"""
        for name, sql in SQL_FILTERED_BY_ID.items():
            found[f"{name}_{graph}"] = sql.format(edges=SQL_EDGES[graph], max_id=MAX_ID[graph])
    found["nodes_csv"] = 'SELECT c_custkey AS "user" FROM customer'
    found["edges_malformed"] = """
        SELECT CAST(NULL AS BIGINT) AS follower, user_id AS "user" FROM events
        UNION ALL SELECT user_id, CAST(NULL AS BIGINT) FROM events
        UNION ALL SELECT user_id, event_id FROM events
        UNION ALL SELECT CAST(NULL AS BIGINT), event_id FROM events
        UNION ALL SELECT user_id, CAST(NULL AS BIGINT) FROM events"""
    found["edges_malformed_lines"] = found["edges_malformed"]
    return found


def _text_queries() -> ModuleType | None:
    """The registered queries of the text subpackage, where that is installed."""
    try:
        from tricycle.llm import registered
    except ModuleNotFoundError as missing:
        if not (missing.name or "").startswith(("tricycle.llm", "corpus_pipeline")):
            warnings.warn(f"without the text queries, as a package that they need is not there: {missing}", stacklevel=2)
        return None
    return registered


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every registered query: the graph operators, and the text operators if there."""
    text = _text_queries()
    return graph_queries() | (text.queries() if text else {})


def oracle_sql() -> dict[str, str]:
    """SQL of the registered queries that SQL can express."""
    text = _text_queries()
    return graph_sql() | (text.oracle_sql() if text else {})
