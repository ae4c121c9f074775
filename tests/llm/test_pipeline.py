"""The pipeline's stages against brute force, and the registered queries against SQL."""

import os
from collections import Counter

import corpus_pipeline
import duckdb
import pytest
from brute import components, contaminated
from test_secrets import spans

import __spark_entry__ as registered
from tricycle.llm import toxicity

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("documents", "pages", "benchmark", "labels", "embeddings")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="given tables not found")


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


def test_stages_do_the_whole_job(spark, documents):
    docs = documents
    kept = [(r.doc_id, r.text) for r in docs.collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    model = toxicity.fit(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    rejected = {r.doc_id for r in toxicity.toxicity(docs, model).where("rejected").collect()}
    kept = [r for r in kept if r[0] not in rejected]
    expected = [kept]
    component = components(kept)
    kept = [r for r in kept if component[r[0]] == r[0]]
    expected.append(kept)
    kept = [r for r in kept if not contaminated(r[1], items)[0]]
    expected.append(kept)
    for (name, stage), rows in zip(corpus_pipeline.STAGES, expected, strict=False):
        docs = stage(spark, docs, SF_DIR)
        assert docs.columns == documents.columns, name
        assert Counter((r.doc_id, r.text) for r in docs.collect()) == Counter(rows), name
    docs = corpus_pipeline.mask_secrets(spark, docs, SF_DIR)
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert set(texts) == {i for i, _ in kept}
    assert all(texts[i] == t for i, t in kept if not spans(t))
    assert all("[SECRET]" in texts[i] and texts[i] != t for i, t in kept if spans(t))
    mix = corpus_pipeline.mix_sources(spark, docs, SF_DIR).collect()
    assert {r.doc_id for r in mix} <= set(texts) and {r.copies for r in mix} <= {1, 2}


def test_run(spark, documents):
    found = corpus_pipeline.run(spark, SF_DIR)
    assert 0 < found.count() < documents.count()
    assert set(documents.columns) <= set(found.columns)


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", [n for n in registered.oracle_sql() if n.startswith("op")])
def test_query_equals_sql(spark, sql, name):
    found = registered.queries()[name](spark, SF_DIR)
    columns = sorted(found.columns)
    relation = sql.sql(registered.oracle_sql()[name])
    assert sorted(relation.columns) == columns
    picked = ", ".join(f'"{c}"' for c in columns)
    assert Counter(map(tuple, found.select(columns).collect())) == Counter(relation.project(picked).fetchall())


def test_all_operators_are_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in registered.queries() if n.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in registered.queries()
