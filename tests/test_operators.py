from collections import Counter

import pytest

import tricycle as tc
from tests import graphs


@pytest.mark.parametrize("name", graphs.KNOWN)
@pytest.mark.parametrize("semantics", tc.SEMANTICS)
def test_triangle_count_known(edges_of, name, semantics):
    edges, known = graphs.KNOWN[name]
    assert [tuple(r) for r in tc.triangle_count(edges_of(edges), semantics).collect()] == [known[semantics]]


@pytest.mark.parametrize("strategy", ["merge", "broadcast"])
@pytest.mark.parametrize("name", ["tri10", "dup", "loop_pair"])
def test_triangle_count_strategies(edges_of, name, strategy):
    edges, known = graphs.KNOWN[name]
    for semantics in tc.SEMANTICS:
        rows = tc.triangle_count(edges_of(edges), semantics, strategy).collect()
        assert [tuple(r) for r in rows] == [known[semantics]]


def test_two_paths_golden(edges_of):
    listed = tc.two_paths(edges_of(graphs.TRI10))
    assert graphs.bag(listed.select("z", "x")) == Counter(graphs.TRI10_ENDS)


def test_follower_count(edges_of):
    rows = tc.follower_count(edges_of(graphs.FOLLOWERS24), sort=True).collect()
    assert tuple(rows[0]) == (25, 4) and tuple(rows[1]) == (8762941, 2)
    assert len(rows) == 20 and all(r.n_followers == 1 for r in rows[2:])
    assert [r.user for r in rows[2:]] == sorted(r.user for r in rows[2:])


def test_follower_count_keeps_null_user(edges_of):
    counts = graphs.bag(tc.follower_count(edges_of([(1, None), (2, None), (None, 3)])))
    assert counts == Counter([(None, 2), (3, 1)])


def test_follower_count_all(spark, edges_of):
    nodes = spark.createDataFrame([(1,), (2,), (3,), (4,), (4,), (None,)], "user LONG")
    rows = tc.follower_count_all(nodes, edges_of(graphs.DUP + [(1, None), (1, 9)])).collect()
    assert graphs.Counter(map(tuple, rows)) == Counter([(2, 2), (1, 1), (3, 1), (4, 0), (4, 0), (None, 0)])
    assert [r.n_followers for r in rows] == [2, 1, 1, 0, 0, 0]


def test_induced_subgraph(edges_of):
    edges = edges_of([(1, 2), (2, 9), (9, 1), (5, 5), (None, 1)])
    assert graphs.bag(tc.induced_subgraph(edges, 5)) == Counter([(1, 2), (5, 5)])
    assert tc.induced_subgraph(edges).count() == 5
    prepared = tc.prepare_edges(edges, max_id=5, partitions=3, cache=True)
    assert graphs.bag(prepared) == Counter([(1, 2), (5, 5)]) and prepared.is_cached
    prepared.unpersist()


def test_null_ids_join_nothing(edges_of):
    edges = edges_of(graphs.DUP + [(None, 1), (2, None), (None, None)])
    assert tuple(tc.triangle_count(edges, "bag").first()) == (6, 2)
    assert graphs.bag(tc.two_paths(edges)) == graphs.paths(graphs.DUP)


@pytest.mark.parametrize("block_size", [3, 100_000])
def test_adjacency(edges_of, block_size):
    edges = graphs.random_edges(5) + [(0, 1)] * 20
    rows = tc.adjacency(edges_of(edges), block_size=block_size).collect()
    lists: dict[int, list[int]] = {}
    for r in sorted(rows, key=lambda r: r.block):
        assert r.followees == sorted(r.followees) and 0 < len(r.followees) <= block_size
        lists.setdefault(r.follower, []).extend(r.followees)
    assert lists == {
        f: sorted(u for g, u in edges if g == f) for f, _ in edges
    }
    assert (len(rows) == len(lists)) == (block_size > 3)
    assert graphs.bag(tc.adjacency_edges(tc.adjacency(edges_of(edges), block_size=block_size))) == Counter(edges)


# With cell_rows=2 nearly every join is split, with block_rows=2 every list; a hot-key
# table of below 6 rows leaves most nodes to the shuffle lookup.
@pytest.mark.parametrize("block_rows, limit", [(10_000, 1_000_000), (2, 1_000_000), (2, 6), (3, 1)])
@pytest.mark.parametrize("cell_rows", [2, 1_000_000])
def test_listings_against_brute_force(edges_of, cell_rows, block_rows, limit):
    raw = graphs.random_edges(cell_rows + block_rows)
    edges = edges_of(raw)
    hot = {"cell_rows": cell_rows, "limit": limit}
    ranked = hot | {"block_rows": block_rows, "plain_paths": 0}
    assert graphs.bag(tc.two_paths(edges, **hot)) == graphs.paths(raw)
    assert graphs.bag(tc.closed_paths_bag(edges, **ranked)) == graphs.closed(raw, "bag")
    assert graphs.bag(tc.closed_paths_semi(edges, keep_degenerate=True, **ranked)) == graphs.closed(raw, "walk")
    assert graphs.bag(tc.cycle_list(edges, **ranked)) == graphs.cycles(raw)
    given = tc.two_paths(edges, keep_degenerate=True)
    assert graphs.bag(tc.close_two_paths(given, edges, limit=limit)) == graphs.closed(raw, "walk")


def test_many_duplicates(edges_of):
    raw = [(1, 2)] * 700 + [(2, 3)] * 300 + [(3, 1)] * 2
    edges = edges_of(raw)
    expected = Counter({(1, 2, 3): 210_000, (2, 3, 1): 600, (3, 1, 2): 1_400})
    listed = tc.two_paths(edges, cell_rows=2).groupBy("x", "y", "z").count()
    assert Counter({(r.x, r.y, r.z): r["count"] for r in listed.collect()}) == expected
    for paths in (0, 10**9):
        listed = tc.closed_paths_semi(edges, plain_paths=paths).groupBy("x", "y", "z").count()
        assert Counter({(r.x, r.y, r.z): r["count"] for r in listed.collect()}) == expected
    listed = tc.close_two_paths(tc.two_paths(edges), edges, "bag").groupBy("x", "y", "z").count()
    assert {r["count"] for r in listed.collect()} == {420_000}
    assert tuple(tc.triangle_count(edges, "bag").first()) == (3 * 420_000, 420_000)


@pytest.mark.parametrize("strategy", ["auto", "merge", "broadcast"])
def test_listings_by_strategy(edges_of, strategy):
    raw = graphs.random_edges(3)
    edges = edges_of(raw)
    assert graphs.bag(tc.two_paths(edges, strategy, keep_degenerate=True)) == graphs.paths(raw, True)
    for paths in (0, 10**9):
        assert graphs.bag(tc.closed_paths_semi(edges, strategy, plain_paths=paths)) == graphs.closed(raw, "semi")
        assert graphs.bag(tc.cycle_list(edges, strategy, plain_paths=paths)) == graphs.cycles(raw)


@pytest.mark.parametrize("limit, block_rows", [(1, 2), (4, 10_000), (1_000_000, 3)])
def test_counts_against_brute_force(edges_of, limit, block_rows):
    raw = graphs.random_edges(limit, nodes=12, edges=70)
    sizes = {"limit": limit, "block_rows": block_rows, "plain_paths": 0}
    edges = edges_of(raw)
    for semantics in ("bag", "semi", "walk"):
        n = sum(graphs.closed(raw, semantics).values())
        assert tuple(tc.triangle_count(edges, semantics, **sizes).first()) == (n, n // 3)
    n = sum(graphs.cycles(raw).values())
    assert tuple(tc.triangle_count(edges, "cycle", **sizes).first()) == (3 * n, n)
    for keep in (False, True):
        n = sum(graphs.paths(raw, keep).values())
        assert tc.two_path_count(edges, keep_degenerate=keep).first().n_paths == n


def test_closing_given_paths(edges_of):
    raw = graphs.random_edges(7)
    edges = edges_of(raw)
    given = tc.two_paths(edges)
    assert graphs.bag(tc.close_two_paths(given, edges, "bag")) == graphs.closed(raw, "bag")
    counts = tc.closing_counts(given.select("z", "x"), edges).where("n_edges > 0")
    assert sum(r.n_paths for r in counts.collect()) == sum(graphs.closed(raw, "semi").values())
    times = Counter(raw)
    assert all(r.n_edges == times[(r.z, r.x)] for r in counts.collect())


def test_stored_path_counts(edges_of):
    raw = graphs.random_edges(13)
    edges, ends = edges_of(raw), tc.two_paths(edges_of(raw)).select("z", "x")
    for how in ("semi", "bag"):
        n = sum(graphs.closed(raw, how).values())
        assert tuple(tc.stored_path_count(ends, edges, how).first()) == (n, n // 3)
    assert tuple(tc.stored_path_count(ends.limit(0), edges).first()) == (0, 0)
    with pytest.raises(ValueError):
        tc.stored_path_count(ends, edges, "walk")


def test_blocks_of_negative_and_large_ids(edges_of):
    ids = [-(2**62), -70_000, -1, 0, 1, 65_535, 65_536, 2**33, 2**48, 2**62]
    raw = [(1, u) for u in ids for _ in range(3)] + [(2, 5)]
    rows = tc.adjacency(edges_of(raw), block_size=4, limit=1).where("follower = 1").orderBy("block").collect()
    assert [len(r.followees) for r in rows] == [4] * 7 + [2]
    assert [u for r in rows for u in r.followees] == sorted(u for u in ids for _ in range(3))


def test_negative_and_large_ids(edges_of):
    big = 2**62
    assert graphs.bag(tc.cycle_list(edges_of([(big, -5), (-5, 7), (7, big)]))) == Counter([(-5, 7, big)])


def test_unknown_names(edges_of):
    edges = edges_of(graphs.DUP)
    with pytest.raises(ValueError):
        tc.triangle_count(edges, "set")
    with pytest.raises(ValueError):
        tc.triangle_count(edges, "bag", strategy="RS_X")
    with pytest.raises(ValueError):
        tc.close_two_paths(edges, edges, how="inner")


@pytest.mark.parametrize("small_edges", [0, 1_000_000])
def test_path_ends_are_the_ends_of_two_paths(edges_of, small_edges):
    raw = graphs.random_edges(17) + [(0, 1)] * 300
    edges = edges_of([*raw, (None, 0), (0, None)])
    for keep in (False, True):
        expected = Counter()
        for (x, _, z), n in graphs.paths(raw, keep).items():
            expected[(z, x)] += n
        ends, found = tc.two_path_ends(edges, keep, small_edges).collect(), Counter()
        for r in ends:
            found[(r.z, r.x)] += r.n_paths
        assert found == expected and (not small_edges or len(ends) == len(expected))
    assert tc.two_path_ends(edges.limit(0)).collect() == []


def test_folded_ends_are_stored_once_and_count_as_their_paths(spark, edges_of, tmp_path):
    raw = [(1, 2)] * 70 + [(2, 3)] * 30 + [(3, 1)] * 2
    edges = edges_of(raw)
    path, stored = str(tmp_path / "text"), str(tmp_path / "buckets")
    tc.write_two_paths(tc.two_path_ends(edges), path)
    assert sorted(r.value for r in spark.read.text(path).collect()) == ["1,2,60", "2,3,140", "3,1,2100"]
    ends = tc.read_two_paths(spark, path, "FAILFAST", counted=True)
    assert tuple(tc.stored_path_count(ends, edges, "bag").first()) == (3 * 4200, 4200)
    tc.write_two_paths(tc.two_path_ends(edges), stored, buckets=3)
    closed = tc.bucketed_closing_counts(tc.read_two_paths(spark, stored, buckets=3, counted=True), edges)
    assert graphs.bag(closed) == Counter([(1, 2, 70, 60), (2, 3, 30, 140), (3, 1, 2, 2100)])


def test_paths_that_no_edge_closes_are_dropped_before_they_are_counted(spark, edges_of):
    """100 * 100 two-paths through one node, of which one is closed."""
    raw = [(k, 0) for k in range(1, 101)] + [(0, k) for k in range(101, 201)] + [(200, 1)]
    closed = tc.close_two_paths(tc.two_paths(edges_of(raw)), edges_of(raw))
    assert graphs.bag(closed) == Counter([(1, 0, 200), (0, 200, 1), (200, 1, 0)])
    (kept,) = {f.rsplit("/", 1)[0] for f in closed.inputFiles() if "candidates-" in f}
    assert spark.read.parquet(kept).count() < 500
