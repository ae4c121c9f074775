import subprocess
import sys
from collections import Counter
from types import SimpleNamespace

import pytest

import tricycle as tc
from tests import graphs
from tricycle.plans import shared_path


def write_lines(tmp_path, name, lines):
    path = tmp_path / name
    path.write_text("\n".join(lines))
    return str(path)


def test_read_edges(spark, tmp_path):
    path = write_lines(tmp_path, "edges.csv", ["1,2", "01,2", "3,11316811"])
    edges = tc.read_edges(spark, path)
    assert edges.dtypes == [("follower", "bigint"), ("user", "bigint")]
    assert graphs.bag(edges) == Counter({(1, 2): 2, (3, 11316811): 1})
    assert graphs.bag(tc.read_edge_lines(spark, path)) == graphs.bag(edges)


def test_malformed_edges(spark, tmp_path):
    path = write_lines(tmp_path, "bad.csv", ["1,2", "x,7", "9"])
    expected = Counter([(1, 2), (None, 7), (9, None)])
    assert graphs.bag(tc.read_edges(spark, path)) == expected
    assert graphs.bag(tc.read_edge_lines(spark, path)) == expected
    strict = tc.read_edges(spark, path, mode="FAILFAST")
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST"):
        strict.collect()
    # Also where the query reads the good column only.
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST"):
        tc.follower_count(strict).collect()


AWKWARD = [" 3, 4", '"8","9"', "", "  \t", "1,2,3", "7,99999999999999999999", "5,\t6\r", ",2", "4"]
PARSED = [(3, 4), (None, None), (1, 2), (7, None), (5, 6), (None, 2), (4, None)]


def test_all_readers_follow_one_rule(spark, tmp_path):
    path = write_lines(tmp_path, "awkward.csv", AWKWARD)
    for rows in (tc.read_edges(spark, path), tc.read_edge_lines(spark, path), tc.read_two_paths(spark, path)):
        assert graphs.bag(rows) == Counter(PARSED)
    assert graphs.bag(tc.read_nodes(spark, path)) == Counter((a,) for a, _ in PARSED)
    good = Counter(p for p in PARSED if None not in p)
    assert graphs.bag(tc.read_edges(spark, path, "DROPMALFORMED")) == good
    for read in (tc.read_edges, tc.read_nodes, tc.read_two_paths):
        with pytest.raises(Exception, match="malformed line"):
            read(spark, path, mode="FAILFAST").collect()
    with pytest.raises(Exception, match="malformed line"):
        tc.read_edge_lines(spark, path, mode="FAILFAST").select("follower").collect()
    with pytest.raises(ValueError):
        tc.read_edges(spark, path, mode="LENIENT")


def test_separator_is_literal(spark, tmp_path):
    path = write_lines(tmp_path, "bars.txt", ["1||2", "3||4||5"])
    assert graphs.bag(tc.read_edges(spark, path, sep="||")) == Counter([(1, 2), (3, 4)])
    assert graphs.bag(tc.read_edge_lines(spark, path, sep="||")) == Counter([(1, 2), (3, 4)])


def test_read_nodes(spark, tmp_path):
    nodes = tc.read_nodes(spark, write_lines(tmp_path, "nodes.csv", ["1", "2", "2"]))
    assert nodes.dtypes == [("user", "bigint")] and graphs.bag(nodes) == Counter({(1,): 1, (2,): 2})


@pytest.mark.parametrize("format", ["csv", "text", "parquet"])
def test_write_counts(spark, edges_of, tmp_path, format):
    counts = tc.follower_count(edges_of(graphs.DUP + [(1, None)]))
    path = str(tmp_path / format)
    tc.write_counts(counts, path, format)
    with pytest.raises(Exception, match="(?i)exist"):
        tc.write_counts(counts, path, format)
    tc.write_counts(counts, path, format, mode="overwrite")
    schema = "user LONG, n_followers LONG"
    back = spark.read.parquet(path) if format == "parquet" else spark.read.schema(schema).csv(path)
    assert graphs.bag(back) == graphs.bag(counts)
    with pytest.raises(ValueError):
        tc.write_counts(counts, path, "orc-ish")


def test_text_separator(spark, edges_of, tmp_path):
    path = str(tmp_path / "text")
    tc.write_counts(tc.follower_count(edges_of(graphs.DUP)), path, "text", sep="\t\t :")
    assert sorted(r.value for r in spark.read.text(path).collect()) == ["1\t\t :1", "2\t\t :2", "3\t\t :1"]


def test_two_paths_kept(spark, edges_of, tmp_path):
    path = str(tmp_path / "two-paths")
    tc.write_two_paths(tc.two_paths(edges_of(graphs.TRI10)), path)
    assert sorted(r.value for r in spark.read.text(path).collect()) == sorted(
        f"{z},{x}" for z, x in graphs.TRI10_ENDS
    )
    closed = tc.closing_counts(tc.read_two_paths(spark, path), edges_of(graphs.TRI10)).where("n_edges > 0")
    assert sum(r.n_paths for r in closed.collect()) == 9


def test_edge_table(spark):
    table = spark.createDataFrame([(1, "2")], "a INT, b STRING")
    edges = tc.edge_table(table, "a", "b")
    assert edges.dtypes == [("follower", "bigint"), ("user", "bigint")] and tuple(edges.first()) == (1, 2)


def test_shared_path_follows_the_session():
    def session(**settings):
        return SimpleNamespace(
            conf=SimpleNamespace(get=lambda key, default=None: settings.get(key, default)),
            sparkContext=SimpleNamespace(master="local[2]", applicationId="app-1"),
        )

    named = session(**{"spark.checkpoint.dir": "hdfs:///shared/"})
    assert shared_path(named, "edges").startswith("hdfs:///shared/app-1/edges-")
    assert shared_path(named, "edges") != shared_path(named, "edges")
    unnamed = session(**{"spark.sql.warehouse.dir": "hdfs:///warehouse"})
    assert shared_path(unnamed, "edges").startswith("hdfs:///warehouse/shared/app-1/edges-")


def test_text_sorted_within_files(spark, edges_of, tmp_path):
    path = str(tmp_path / "sorted")
    tc.write_counts(tc.follower_count(edges_of(graphs.TRI10)).coalesce(1), path, "text", order_by="user")
    users = [int(r.value.split(",")[0]) for r in spark.read.text(path).collect()]
    assert users == sorted(users)


def test_a_local_warehouse_is_no_shared_folder_of_a_cluster():
    from tricycle.plans.shared import _fallback

    assert _fallback("file:/tmp/warehouse", "local[8]") == "file:/tmp/warehouse/shared"
    assert _fallback("hdfs://host/warehouse/", "yarn") == "hdfs://host/warehouse/shared"
    for warehouse in ("file:/tmp/warehouse", "/tmp/warehouse"):
        with pytest.raises(ValueError, match="checkpoint.dir"):
            _fallback(warehouse, "spark://host:7077")


@pytest.mark.parametrize("package", ["xxhash", "numpy"])
def test_graph_queries_do_without_the_packages_of_text_queries(package):
    code = f"import sys; sys.modules['{package}'] = None; import __spark_entry__ as e; print(len(e.queries()) == len(e.graph_queries()))"
    found = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True)
    assert found.stdout.strip() == "True", found.stderr
