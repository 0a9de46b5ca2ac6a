"""Corpus pipeline: quality -> near duplicates -> decontamination -> mixing -> sharding.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and is
written as Parquet in the shared folder and read again as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.llm import decontaminate, mixing, ngram_join, quality_knn, sharding
from wattlake.llm import queries as Q
from wattlake.llm.common import crc_mod, prepare, stage, table

NEAR = ngram_join.Rule(words=5, num=80, den=100)       # near duplicates; op3_ngram_join has its own rule


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the cut; the others go."""
    prepare(spark)
    labels = table(spark, sf_dir, "labels")
    model = quality_knn.fit(docs, labels.where(crc_mod("doc_id", 5) != 0))
    return quality_knn.score(docs, model, "__score").where(F.col("__score") >= Q.QUALITY_CUT).drop("__score")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of the join of 5-word shingles at a similarity of 0.8: the one with the smallest id."""
    prepare(spark)
    return ngram_join.one_of_each(docs, rule=NEAR)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    prepare(spark)
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents selected under hierarchical token budgets; one row per epoch that takes a document."""
    prepare(spark)
    return mixing.select_mix(docs, Q.domain_of(), Q.MIX_WEIGHTS, Q.MIX_SEED, (1, 1), Q.MIX_EPOCHS).select(*docs.columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document with its slot and shard."""
    prepare(spark)
    return sharding.assign(docs, "doc_id", Q.SHARDS)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("mixing", mix), ("sharding", shard)]

ORACLE_SQL = None   # the classifier and the edit-distance search are not SQL; tests hold each stage against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for i, (name, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stage(spark, docs, f"pipeline-{name}")
    return docs
