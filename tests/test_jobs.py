import pytest

from tests import graphs
from tricycle.jobs import run


@pytest.fixture
def edge_file(tmp_path):
    path = tmp_path / "edges.csv"
    path.write_text("\n".join(f"{a},{b}" for a, b in graphs.TRI8))
    return str(path)


def test_follower_count_job(spark, tmp_path, edge_file):
    output = str(tmp_path / "out")
    run(spark, ["follower-count", edge_file, output, "--max-id", "-1"])
    back = spark.read.schema("user LONG, n_followers LONG").csv(output)
    assert sum(r.n_followers for r in back.collect()) == len(graphs.TRI8)

    nodes = tmp_path / "nodes.csv"
    nodes.write_text("\n".join(str(n) for n in (1, 2, 4)))
    run(spark, ["follower-count", edge_file, output, "--nodes", str(nodes), "--overwrite", "--format", "text"])
    lines = [r.value for r in spark.read.text(output).collect()]
    assert sorted(lines) == ["1,2", "2,1", "4,0"]


def test_triangle_count_job(spark, edge_file):
    assert tuple(run(spark, ["triangle-count", edge_file, "--strategy", "merge"]).first()) == (6, 2)
    assert tuple(run(spark, ["triangle-count", edge_file, "--max-id", "4"]).first()) == (3, 1)


def test_stored_count_job(spark, tmp_path, edge_file):
    paths = tmp_path / "paths.csv"
    paths.write_text("\n".join(f"{z},{x}" for (x, _, z), n in graphs.paths(graphs.TRI8).items() for _ in range(n)))
    assert tuple(run(spark, ["stored-count", edge_file, "--paths", str(paths)]).first()) == (6, 2)


def test_plan_and_metrics_are_printed(spark, tmp_path, edge_file, capsys):
    run(spark, ["triangle-count", edge_file, "--explain", "--metrics"])
    printed = capsys.readouterr().out
    assert "AdaptiveSparkPlan" in printed
    assert f"{{'n_rows': 1, 'wedges': {sum(graphs.paths(graphs.TRI8).values())}, 'closing_hits': 6}}" in printed
    run(spark, ["follower-count", edge_file, str(tmp_path / "out"), "--metrics"])
    assert "{'n_rows': 6}" in capsys.readouterr().out
    back = spark.read.schema("user LONG, n_followers LONG").csv(str(tmp_path / "out"))
    assert back.count() == 6


def test_unknown_strategy(spark, edge_file):
    with pytest.raises(SystemExit):
        run(spark, ["triangle-count", edge_file, "--strategy", "REP"])
