"""What the physical plans must keep to at scale."""

import itertools
import re
import warnings

import pytest

import tricycle as tc
from tests import graphs
from tricycle.plans import bits_for, key_bitmap, maybe_among, numbered
from tricycle.plans.strategy import distinct_edges, sketched_edges


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "edges")
    raw = graphs.random_edges(11, nodes=40, edges=400)
    spark.createDataFrame(raw, "follower LONG, user LONG").write.parquet(path)
    return spark.read.parquet(path)


def test_filter_reaches_the_scan(stored):
    plan = tc.explain_text(tc.follower_count(tc.induced_subgraph(stored, 20)))
    pushed = re.search(r"PushedFilters: \[(.*)\]", plan).group(1)
    assert "LessThanOrEqual(follower,20)" in pushed and "LessThanOrEqual(user,20)" in pushed


def test_count_reads_one_column_and_combines_before_the_shuffle(stored):
    plan = tc.explain_text(tc.follower_count(stored), "simple")
    assert "ReadSchema: struct<user:bigint>" in plan
    assert plan.index("functions=[count(1)]") < plan.index("Exchange") < plan.index("functions=[partial_count(1)]")


def test_join_follows_strategy(stored):
    merge = tc.explain_text(tc.triangle_count(stored, "bag", "merge", plain_paths=0), "simple")
    assert merge.count("SortMergeJoin") >= 2
    broadcast = tc.explain_text(tc.triangle_count(stored, "bag", "broadcast", plain_paths=0), "simple")
    assert "SortMergeJoin" not in broadcast and "BroadcastHashJoin" in broadcast


def test_broadcast_gives_way_above_its_bound_and_says_so(stored):
    n = tc.weighted_edges(stored).count()
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        at = tc.explain_text(tc.two_paths(stored, "broadcast", broadcast_edges=n), "simple")
        # Duplicates of the same edges do not count.
        more = stored.union(stored).union(stored)
        assert tc.explain_text(tc.two_paths(more, "broadcast", broadcast_edges=n), "simple").count("SortMergeJoin") == 0
    with pytest.warns(UserWarning, match="merge instead"):
        above = tc.explain_text(tc.two_paths(stored, "broadcast", broadcast_edges=n - 1), "simple")
    assert "SortMergeJoin" not in at
    assert "SortMergeJoin" in above
    with pytest.warns(UserWarning, match="merge instead"):
        found = tc.triangle_count(stored, "bag", "broadcast", broadcast_edges=10).first()
    assert tuple(found) == tuple(tc.triangle_count(stored, "bag").first())


def test_given_paths_are_shuffled_once(spark, stored, tmp_path):
    path = str(tmp_path / "paths")
    tc.two_paths(stored).write.parquet(path)
    closed = tc.close_two_paths(spark.read.parquet(path), stored, limit=1)
    plan = tc.explain_text(closed, "simple")
    whole = [line for line in plan.splitlines() if re.search(r"FileScan parquet \[x#\d+L,y#\d+L,z#\d+L\]", line)]
    # Rows with y: those that find their ends by broadcast, and those of one shuffle.
    assert len(whole) == 2 and "CartesianProduct" not in plan


@pytest.mark.parametrize(
    "build",
    [
        lambda e: tc.triangle_count(e, "bag", "merge", plain_paths=0),
        lambda e: tc.triangle_count(e, "walk", "merge", plain_paths=0),
        lambda e: tc.cycle_list(e, "merge", plain_paths=0),
        lambda e: tc.closed_paths_bag(e, "merge", plain_paths=0),
        lambda e: tc.two_paths(e, "merge"),
        lambda e: tc.two_path_count(e),
        lambda e: tc.adjacency(e),
    ],
    ids=["count-bag", "count-walk", "cycles", "closed", "two-paths", "two-path-count", "adjacency"],
)
def test_edges_are_scanned_and_shuffled_once(stored, build):
    """Every use of the edges shares the one pre-aggregating shuffle."""
    df = build(stored)
    df.collect()
    plan = executed(tc.explain_text(df, "simple"))
    # None is left where the scan's stage belonged to a branch that turned out empty.
    assert plan.count("FileScan parquet") <= 1, plan


def executed(text: str) -> str:
    """The plan text without the initial plans, which AQE prints after the final ones."""
    kept, initial = [], None
    for line in text.splitlines():
        node = re.search(r"[A-Za-z*=]", line)
        depth = node.start() if node else 0
        if initial is not None and depth >= initial:
            continue
        initial = depth if "== Initial Plan ==" in line else None
        if initial is None:
            kept.append(line)
    return "\n".join(kept)


def test_no_plan_crosses_or_runs_python(stored):
    for df in (
        tc.triangle_count(stored, "walk"),
        tc.triangle_count(stored, "walk", plain_paths=0),
        tc.closed_paths_bag(stored, plain_paths=0),
        tc.two_paths(stored),
        tc.close_two_paths(tc.two_paths(stored), stored),
        tc.adjacency(stored),
    ):
        plan = tc.explain_text(df)
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
        assert "Python" not in plan and "InPandas" not in plan


def test_metrics_come_with_the_action(stored):
    df, observation = tc.with_metrics(tc.follower_count(stored), "counts")
    n = len(df.collect())
    assert observation.get == {"n_rows": n}


def test_the_choice_of_plan_follows_the_number_of_two_paths(edges_of):
    """A node in the middle of 200 * 200 two-paths, of which none is closed."""
    star = edges_of([(k, 0) for k in range(1, 201)] + [(0, k) for k in range(201, 401)])
    few = tc.triangle_count(star, "bag", plain_paths=40_000)
    many = tc.triangle_count(star, "bag", plain_paths=10_000)
    assert "three plain joins" in tc.explain_text(few) and "40000 two-paths of 400 edges" in tc.explain_text(few)
    assert "lowest degree" in tc.explain_text(many)
    assert tuple(few.first()) == tuple(many.first()) == (0, 0)
    assert "lowest degree" in tc.explain_text(tc.triangle_count(star, "bag", plain_paths=0))


def test_copies_of_an_edge_do_not_repeat_the_plan(stored):
    """One cycle join, also where rows have many copies; those are sliced from a written table."""
    plain = tc.closed_paths_bag(stored, "merge", plain_paths=0, chunk=10**9)
    many = tc.closed_paths_bag(stored, "merge", plain_paths=0, chunk=2)
    once = tc.explain_text(plain, "simple").count("SortMergeJoin")
    assert once >= 2 and "Join" not in tc.explain_text(many, "simple")
    assert graphs.bag(plain) == graphs.bag(many)


def test_sketch_counts_distinct_edges_in_parts(spark):
    edges = spark.range(60_000).selectExpr("id % 20000 AS follower", "id % 20000 + 1 AS user")
    plan = tc.explain_text(sketched_edges(edges), "simple")
    assert "SinglePartition" not in plan and "partial_hll_sketch_agg" in plan
    assert abs(distinct_edges(edges) - 20_000) < 0.03 * 20_000


def test_numbered_rows_are_shuffled_once_and_in_order(spark):
    rows = spark.range(5000).selectExpr("id * 7919 % 5003 AS v", "id % 3 AS n")
    found = numbered(rows, "v", copies="n").collect()
    expected = sorted(r.v for r in rows.collect() for _ in range(r.n))
    assert [r.v for r in sorted(found, key=lambda r: r.place)] == expected
    assert sorted(r.place for r in found) == list(range(len(expected)))
    assert numbered(rows.limit(0), "v").collect() == []


def test_a_prepared_graph_is_read_in_place_of_its_edges(stored):
    raw = [tuple(r) for r in stored.collect()]
    graph = tc.prepare_graph(stored)
    for paths in (0, 10**9):
        assert tuple(tc.triangle_count(graph, "bag", plain_paths=paths).first()) == (n := sum(graphs.closed(raw, "bag").values()), n // 3)
        assert graphs.bag(tc.closed_paths_bag(graph, plain_paths=paths)) == graphs.closed(raw, "bag")
        assert graphs.bag(tc.closed_paths_semi(graph, keep_degenerate=True, plain_paths=paths)) == graphs.closed(raw, "walk")
        assert graphs.bag(tc.cycle_list(graph, plain_paths=paths)) == graphs.cycles(raw)
    assert tc.two_path_count(graph, True).first().n_paths == sum(graphs.paths(raw, True).values())
    plans = tc.explain_text(tc.triangle_count(graph, "bag", plain_paths=0)) + tc.explain_text(tc.cycle_list(graph))
    assert "/edges" not in plans and "/graph-" in plans
    small = tc.prepare_graph(stored, max_id=20)
    assert tuple(tc.triangle_count(small, "walk").first()) == tuple(tc.triangle_count(tc.induced_subgraph(stored, 20), "walk").first())


def test_bucketed_paths_are_closed_without_a_shuffle(spark, stored, tmp_path):
    path = str(tmp_path / "it's bucketed")
    tc.write_two_paths(tc.two_paths(stored), path, buckets=5)
    ends = tc.read_two_paths(spark, path, buckets=5)
    closed = tc.bucketed_closing_counts(ends, stored)
    plan = tc.explain_text(closed, "simple")
    edges_side = re.findall(r"Exchange hashpartitioning\((\w+)#", plan)
    assert "Bucketed: true" in plan and set(edges_side) == {"follower"}, plan
    expected = tc.closing_counts(tc.two_paths(stored).select("z", "x"), stored).where("n_edges > 0 AND n_paths > 0")
    assert graphs.bag(closed) == graphs.bag(expected.select(closed.columns))
    with pytest.raises(Exception, match="(?i)exist|empty"):
        tc.write_two_paths(tc.two_paths(stored), path, buckets=5)


def test_a_bitmap_loses_no_key_and_drops_most_others(spark):
    keys = spark.range(20_000).selectExpr("id * 3 AS a", "-id AS b")
    bits = bits_for(20_000)
    assert bits == 262_144
    bitmap = key_bitmap(keys, ["a", "b"], bits)
    rows = spark.range(60_000).selectExpr("id AS a", "-(id div 3) AS b", "'x' AS more")
    kept = maybe_among(rows, ["a", "b"], bitmap, bits)
    plan = tc.explain_text(kept, "simple")
    assert kept.columns == ["a", "b", "more"] and "BroadcastHashJoin" in plan
    assert plan.count("Exchange hashpartitioning") == 1  # of the keys' places; rows stay where they are
    found = {r.a for r in kept.collect()}
    assert set(range(0, 60_000, 3)) <= found
    assert len(found) < 20_000 + 40_000 / 8
    # Every place of one block: each bit is read where it was set.
    ends = key_bitmap(spark.range(400).selectExpr("id AS a"), ["a"], 32_768)
    assert maybe_among(spark.range(400).selectExpr("id AS a"), ["a"], ends, 32_768).count() == 400
    assert sum(bin(w & (2**64 - 1)).count("1") for r in ends.collect() for w in r.words) <= 400
    assert maybe_among(rows, ["a", "b"], key_bitmap(keys.limit(0), ["a", "b"], bits), bits).count() == 0


def test_bits_have_a_bound():
    assert bits_for(0) == bits_for(1) == bits_for(4096) == 32_768
    assert bits_for(4097) == 65_536
    assert bits_for(10**8) == 1 << 29
    assert bits_for(10**9) == 0 and bits_for(10, most=100) == 0


def test_bitmap_changes_what_is_shuffled_and_not_the_result(spark, edges_of):
    """A bipartite graph with wedges at every node and no cycle, and one cycle beside it."""
    sparse = [(a, b) for a in range(30) for b in range(100, 130)] + [(b, a) for a in range(30) for b in range(100, 130)]
    raw = [*sparse, (500, 501), (501, 502), (502, 500)]
    for operator in (lambda **k: tc.triangle_count(edges_of(raw), "semi", "merge", plain_paths=0, **k),
                     lambda **k: tc.cycle_list(edges_of(raw), "merge", plain_paths=0, **k)):
        found = {}
        for bits in (0, 1 << 20):
            counters = tc.RunCounters()
            rows = [tuple(r) for r in counters.done(operator(bitmap_bits=bits, counters=counters)).collect()]
            found[bits] = rows, counters.values
        (plain, before), (filtered, after) = found.values()
        assert plain == filtered and before["wedges"] == after["wedges"] > 10_000
        assert "wedges_kept" not in before
        assert 1 <= after["wedges_kept"] < 0.25 * after["wedges"]
        assert before["closing_hits"] == after["closing_hits"] == 1
    assert "getbit" not in tc.explain_text(tc.cycle_list(edges_of(raw), "broadcast", plain_paths=0))


def test_join_cells_are_seen_to_be_bounded(spark, edges_of):
    """Every node of a complete graph has a list of higher ones, cut to blocks of about 10."""
    raw = list(itertools.permutations(range(120), 2))
    counters = tc.RunCounters()
    found = counters.done(
        tc.triangle_count(edges_of(raw), "cycle", "merge", block_rows=10, plain_paths=0, counters=counters)
    ).first()
    assert found.triangles == 2 * 120 * 119 * 118 // 6
    assert counters.values["wedges"] == 120 * 119 * 118 // 6
    assert 100 <= counters.values["largest_cell"] <= 30 * 30
    whole = tc.RunCounters()
    whole.done(tc.triangle_count(edges_of(raw), "cycle", "merge", plain_paths=0, counters=whole)).collect()
    assert whole.values["largest_cell"] == 119 * 119


def test_counters_of_steps_that_were_left_out(spark, edges_of):
    counters = tc.RunCounters()
    with pytest.raises(ValueError, match="done"):
        counters.values
    assert counters.done(tc.cycle_list(edges_of([(1, 1)]), plain_paths=0, counters=counters)).count() == 0
    values = counters.values
    assert values["n_rows"] == 0 and not values["closing_hits"] and not values["wedges"]


def test_parts_follow_the_number_of_paths(spark):
    n = 3000
    star = spark.range(n).selectExpr("explode(array(struct(id + 1 AS follower, 0L AS user), struct(0L AS follower, -id - 1 AS user))) AS e")
    assert tc.path_parts(star.select("e.*")) == 10
    assert tc.path_parts(star.select("e.*").limit(0)) == 1
