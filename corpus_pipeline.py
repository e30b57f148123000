"""A corpus from raw documents to packed training sequences, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from valence.llm import decontaminate, language_id, near_dedup, packing, toxicity
from valence.llm.common import fold, small_batches
from valence.llm.queries import digests
from valence.session import prepare
from valence.sinks.writers import stage
from valence.sources.tables import table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go; null and empty texts get the base score, null ids and repeated rows are judged like any other."""
    return toxicity.without_toxic(docs, table(small_batches(spark), sf_dir, "labels"))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go: null texts and those without a letter; null ids and repeated rows are judged like any other."""
    small_batches(spark)
    model = language_id.learn(docs.where(fold("doc_id", 3) != 1))
    return language_id.with_language(docs, model)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest id, by the operator's SimHash and distance.

    Null ids stay; null and empty texts are one group; repeated rows stay once.
    """
    small_batches(spark)
    return near_dedup.keep_first(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go; null and empty texts hold none and stay."""
    return decontaminate.without_leaks(docs, table(small_batches(spark), sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every id of the documents left, in sequences; null and empty texts are their end mark alone, repeated rows are packed each."""
    small_batches(spark)
    return digests(packing.pack(docs))


STAGES = [
    ("toxicity", toxicity_stage),
    ("language_id", language_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]
# Classifiers, fingerprints and token ids have no SQL; the stages are tested against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written and read again as the next one's input."""
    docs = table(prepare(spark), sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
