"""A corpus from raw documents: five stages, each over all that the one before kept.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last
return the columns of ``documents``. ``run`` writes each stage's rows to the shared
folder and reads them again, so that a lost executor repeats one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tricycle.llm import toxicity
from tricycle.llm.decontaminate import decontaminated
from tricycle.llm.minhash import deduplicated
from tricycle.llm.mixing import mixed
from tricycle.llm.secrets import masked
from tricycle.plans import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents whose toxicity reaches their language's threshold."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.toxicity(docs, model).where("NOT rejected").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return deduplicated(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents in which a window of a benchmark item occurs."""
    return decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets in their texts masked."""
    return masked(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, with the number of copies that it takes of each."""
    return mixed(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", mask_secrets),
    ("mixing", mix_sources),
]

# A trained network and component labels are beyond SQL; tests compare the stages with
# brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
