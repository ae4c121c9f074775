"""Hot keys: results stay whole, and work does not follow the hub."""

from collections import Counter

import pytest

import tricycle as tc
from tests import graphs
from tricycle.operators.cycles import wedges
from tricycle.operators.pairs import pair_table, ranked_pairs
from tricycle.plans import expand_copies, hot_keys, looked_up


def test_hot_keys_are_bounded(spark):
    counts = spark.createDataFrame([(i, 1) for i in range(50)] + [(99, 30), (98, 20)], "node LONG, n LONG")
    assert {r.node for r in hot_keys(counts, "n", limit=10).collect()} == {98, 99}
    assert {r.node for r in hot_keys(counts, "n", limit=10, floor=25).collect()} == {99}
    assert hot_keys(counts, "n", limit=1000).count() == 52


def test_expand_copies_in_chunks(spark):
    rows = spark.createDataFrame([(1, 1), (2, 7), (3, 8), (4, 29)], "v LONG, copies LONG")
    assert graphs.bag(expand_copies(rows, chunk=7)) == Counter({(1,): 1, (2,): 7, (3,): 8, (4,): 29})


def test_few_copies_are_not_shuffled(spark):
    rows = spark.createDataFrame([(1, 1), (2, 7), (3, 8)], "v LONG, copies LONG")
    plan = tc.explain_text(expand_copies(rows, chunk=7), "simple")
    few, many = plan[plan.index("Union") :].split("Exchange", 1)
    assert "copies" in few and "(copies" in many and many.count("Exchange") == 0


@pytest.mark.parametrize("limit", [1, 5, 1_000_000])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_is_whole(spark, limit, how):
    keys = [0] * 50 + [k % 9 for k in range(60)] + [77]
    rows = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "key LONG, i LONG")
    table = spark.createDataFrame([(k, keys.count(k)) for k in range(9)], "key LONG, n LONG")
    found = looked_up(rows, ["key"], table, "n", limit, how=how)
    expected = Counter((k, i, keys.count(k) if k != 77 else None) for i, k in enumerate(keys) if how == "left" or k != 77)
    assert graphs.bag(found) == expected


@pytest.mark.parametrize("limit", [1, 20, 1_000_000])
def test_degrees_are_exact_whatever_the_table_of_hot_nodes(edges_of, limit):
    raw = graphs.random_edges(21, nodes=40, edges=400)
    links = {frozenset(e) for e in raw if e[0] != e[1]}
    degree = Counter(n for link in links for n in link)
    found = ranked_pairs(pair_table(edges_of(raw)), limit).collect()
    assert {frozenset((r.a, r.b)) for r in found} == links and len(found) == len(links)
    assert all((r.degree_a, r.degree_b) == (degree[r.a], degree[r.b]) for r in found)
    tried = wedges(pair_table(edges_of(raw)), "auto", limit).count()
    assert tried == wedges(pair_table(edges_of(raw)), "auto").count()


def test_blocks_of_a_dense_graph(spark):
    """All of 200 nodes linked both ways: every list is long, each two meet once."""
    n = 200
    edges = spark.range(n).selectExpr("id AS follower", f"explode(sequence(0L, {n - 1}L)) AS user").where("follower <> user")
    table = pair_table(edges)
    found = wedges(table, "auto", block_rows=16)
    assert found.count() == found.select("u", "a", "b").distinct().count() == n * (n - 1) * (n - 2) // 6
    assert tuple(tc.triangle_count(edges, "cycle", block_rows=16, plain_paths=0).first()) == (n * (n - 1) * (n - 2), n * (n - 1) * (n - 2) // 3)
    # Blocks hold about as many neighbours as they should, by the hash that deals them.
    longest = max(
        r["count"]
        for r in ranked_pairs(table)
        .selectExpr("a AS u", "b AS v", f"int(1 + {n - 1} div 16) AS blocks")
        .selectExpr("u", "int(pmod(xxhash64(v), blocks)) AS block").groupBy("u", "block").count().collect()
    )
    assert longest < 3 * 16


@pytest.fixture(scope="module")
def hub_graph(spark):
    """Node 0 is followed by and follows 60,000 nodes, which form a ring; one edge
    is there 60,000 times. It has 3.6 billion two-paths through the hub."""
    n = 60_000
    ids = spark.range(n)
    return (
        ids.selectExpr("id + 1 AS follower", "0L AS user")
        .union(ids.selectExpr("0L AS follower", "id + 1 AS user"))
        .union(ids.selectExpr("id + 1 AS follower", f"(id + 1) % {n} + 1 AS user"))
        .union(ids.selectExpr("1L AS follower", "2L AS user"))
    )


def test_hub_counts(hub_graph):
    n = 60_000
    # Ring edge i→i+1 closes 0→i→i+1→0; 1→2 is there n + 1 times.
    assert tuple(tc.triangle_count(hub_graph, "cycle").first()) == (3 * n, n)
    assert tuple(tc.triangle_count(hub_graph, "bag", "merge").first()) == (3 * (n - 1 + n + 1), 2 * n)
    assert tc.two_path_count(hub_graph).first().n_paths > n * n


def test_hub_listing(hub_graph):
    n = 60_000
    assert tc.cycle_list(hub_graph, cell_rows=10_000).count() == n
    assert tc.closed_paths_bag(hub_graph, cell_rows=10_000).count() == 3 * (n - 1 + n + 1)


def test_hub_adjacency_blocks(hub_graph):
    blocks = tc.adjacency(hub_graph, block_size=10_000).where("follower < 2")
    sizes = blocks.selectExpr("follower", "size(followees) AS n").collect()
    assert sum(r.n for r in sizes if r.follower == 0) == 60_000
    assert sum(r.n for r in sizes if r.follower == 1) == 60_002
    assert max(r.n for r in sizes) == 10_000
