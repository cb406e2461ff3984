"""From raw documents to a training mix: five stages, each over all that the one before kept.

A stage is (name, function); a function takes (spark, docs, sf_dir) and returns
a DataFrame. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickloom.llm import decontaminate, line_dedup, mixing, quality, simhash
from tickloom.llm._common import Store, cleaned, table


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts (op4)."""
    return quality.good_documents(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that are near copies of earlier ones (op5)."""
    return line_dedup.without_repeats(docs)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (op9)."""
    return simhash.one_of_each(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage of weight (op3)."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the source mix takes, with how often (op10)."""
    return mixing.mixed_documents(docs)


STAGES = [("quality", good), ("line_dedup", lines), ("near_duplicates", distinct), ("decontamination", clean), ("mixing", mixed)]

#: The stages train a model, sketch lines and hash shingles, which SQL cannot express; tests/llm compares them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each stage's result is written before the next reads it, and goes with the stage's intermediates once it has been read."""
    store = Store(spark)
    docs, before = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        with cleaned():
            docs = store.keep(stage(spark, docs, sf_dir))
        if before is not None:
            store.drop(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
