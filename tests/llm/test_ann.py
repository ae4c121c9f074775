import numpy as np
import pytest
from pyspark.sql import functions as F

from tricycle.llm.ann import nearest_neighbours


def exact(rows, queries, nearest):
    """Nearest by brute force, per query id."""
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], dtype=np.float64)
    found = {}
    for k in range(len(ids)):
        if ids[k] % queries == 0 and ids[k] not in found:
            score = (x * x[k]).sum(axis=1)
            other = ids != ids[k]
            order = np.lexsort((ids[other], -score[other]))[:nearest]
            found[ids[k]] = list(zip(ids[other][order].tolist(), score[other][order].tolist(), strict=True))
    return found


@pytest.mark.parametrize("chunk", [4096, 64])
def test_recall_and_scores(spark, chunk):
    rng = np.random.default_rng(chunk)
    centres = rng.normal(size=(12, 24))
    vectors = (centres[rng.integers(0, 12, 3000)] + rng.normal(size=(3000, 24))) * rng.uniform(0.5, 2, (3000, 1))
    rows = [(k, v.astype(np.float32).tolist()) for k, v in enumerate(vectors)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("list", F.lit(1))
    found = nearest_neighbours(table, F.col("vec_id") % 50 == 0, nearest=10, chunk=chunk).toPandas()
    expected = exact(rows, 50, 10)
    hits = 0
    for query, own in found.sort_values("rank").groupby("query_id"):
        assert list(own["rank"]) == list(range(1, 11)) and query not in set(own.vec_id)
        assert list(zip(-own.score, own.vec_id, strict=True)) == sorted(zip(-own.score, own.vec_id, strict=True))
        hits += len(set(own.vec_id) & {v for v, _ in expected[query]})
        known = dict(exact(rows, query, 3000)[query]) if query else None
        if known:
            assert all(known[v] == s for v, s in zip(own.vec_id, own.score, strict=True))
    assert set(found.query_id) == set(expected)
    assert hits / (10 * len(expected)) >= 0.9


def test_ties_repeats_and_unusable_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(k, [1.0, 2.0]) for k in range(30)] + [(0, [1.0, 2.0]), (100, [2.0, 1.0]), (100, [2.0, 1.0])]
    bad = [(40, None), (60, [0.0, 0.0]), (61, [nan, 1.0]), (62, [1.0, inf]), (63, [None, 1.0]), (64, [1.0]), (None, [1.0, 1.0]), (65, [])]
    table = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>")
    found = nearest_neighbours(table, F.col("vec_id") % 20 == 0, nearest=5).toPandas()
    expected = exact(rows, 20, 5)
    mine = {q: list(zip(g.vec_id, g.score, strict=True)) for q, g in found.sort_values("rank").groupby("query_id")}
    assert mine == expected


def test_few_rows_and_none(spark):
    schema = "vec_id long, embedding array<float>"
    assert nearest_neighbours(spark.createDataFrame([], schema), F.lit(True)).collect() == []
    assert nearest_neighbours(spark.createDataFrame([(1, [1.0])], schema), F.lit(True)).collect() == []
    two = nearest_neighbours(spark.createDataFrame([(1, [1.0]), (2, [-3.0])], schema), F.lit(True)).collect()
    assert sorted(map(tuple, two)) == [(1, 1, 2, -3.0), (2, 1, 1, -3.0)]
