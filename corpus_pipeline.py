"""A corpus pipeline of five stages, each one of the operators of arcrelief.llm.

Every stage but the last returns the columns of ``documents``; other columns are left out, so
none can clash.  Null texts are empty texts to all stages.  An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arcrelief.llm import jaccard_join, packing, quality_rules, secret_scan, toxicity
from arcrelief.llm.store import read_table, staged

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.3 by a classifier learned from the labelled ones stay."""
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, keep=COLUMNS).where("score < 0.3").select(*COLUMNS)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents stay that neither the base nor a rule learned from the labelled ones rejects."""
    rules = quality_rules.fit(docs, read_table(spark, sf_dir, "labels"))
    return quality_rules.judge(docs, rules, keep=COLUMNS).where("kept").select(*COLUMNS)


def near_copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones stays (five words, 0.8).

    A document is told by its doc_id and text together: rows of one doc_id with different texts
    are documents of their own, and of rows equal in both one stays.  Of each group the document with
    the smallest doc_id stays (nulls last; then by a hash of both).
    """
    keyed = docs.select(*COLUMNS, F.xxhash64("doc_id", F.xxhash64("text"), "text").alias("_key"))
    groups = staged(
        jaccard_join.similar_groups(keyed.select(F.col("_key").alias("doc_id"), "text"))
        .select(F.col("doc_id").alias("_key"), F.col("component_id").alias("_group")).distinct(), "groups")
    first = (
        groups.join(keyed.select("_key", "doc_id").distinct(), "_key")
        .groupBy("_group").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_key"))["_key"].alias("_key"))
    )
    return keyed.join(first.select("_key"), "_key", "left_semi").dropDuplicates(["_key"]).select(*COLUMNS)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; live credentials in their texts are masked."""
    return secret_scan.masked(docs.select(*COLUMNS))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a sequence, with its token ids."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("quality_rules", quality_stage),
    ("jaccard_join", near_copies_stage),
    ("secret_scan", secrets_stage),
    ("packing", packing_stage),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
