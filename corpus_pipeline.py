"""Corpus pipeline: documents -> quality -> near copies -> benchmark leaks -> mix -> shards.

Every stage is one operator of ``biblink.llm``.  A stage takes what its
predecessor kept, all columns of ``documents`` included; the last one adds the
shard number.  ``run`` applies the stages in order, each written to the shared
folder and read back, so a lost executor never repeats an earlier stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from biblink.llm import decontaminate, quality_rules, queries, shards, simhash
from biblink.llm.common import fresh, written

#: Token share that the mixing stage keeps.
MIX_BUDGET = 0.8

#: The stages learn, hash and sample: SQL cannot express them.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor the learned list reject."""
    counts, kept = fresh(docs.columns, "counts", "kept")
    featured = quality_rules.with_features(docs, into=counts)
    narrow = written(featured.select("doc_id", F.col(counts).alias("counts")), "counts")
    rules = queries.quality_list(spark, sf_dir, narrow)
    return featured.withColumn(kept, quality_rules.judge(featured, rules, counts)[1]).where(F.col(kept)).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: the one with the smallest ``doc_id``."""
    return simhash.drop_near_duplicates(docs, shingle=4, max_bits=4)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    return decontaminate.remove_leaking(docs, queries.table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled to the target shares."""
    into = tuple(fresh(docs.columns, "n_tokens", "weight", "probability", "sampled"))
    return queries.mixed(docs, MIX_BUDGET, into=into).where(F.col(into[3])).select(*docs.columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard number."""
    return shards.assign(docs, "doc_id", [1.0] * queries.SHARDS, fresh(docs.columns, "shard")[0])


STAGES = [("quality", quality), ("near_copies", near_copies), ("leaks", leaks), ("mix", mix), ("shard", shard)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = written(docs, name)
    return docs
