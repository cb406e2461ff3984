"""The registered queries of this subpackage, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tickloom.llm import codes, credentials, decontaminate, fingerprint, hmm, licenses, line_dedup, mixing, quality, simhash, suffix_dedup, toxicity, yinyang
from tickloom.llm._common import table


def op1_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_edited(table(spark, sf_dir, "documents"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credentials.scan(table(spark, sf_dir, "documents"))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op11_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compress(table(spark, sf_dir, "embeddings"))


def op12_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.scores(table(spark, sf_dir, "documents"))


def op13_yinyang(spark: SparkSession, sf_dir: str) -> DataFrame:
    return yinyang.clusters(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_fingerprint": op1_fingerprint,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_decontaminate": op3_decontaminate,
    "op4_quality": op4_quality,
    "op5_line_dedup": op5_line_dedup,
    "op6_toxicity": op6_toxicity,
    "op7_secrets": op7_secrets,
    "op8_licenses": op8_licenses,
    "op9_simhash": op9_simhash,
    "op10_mixing": op10_mixing,
    "op11_codes": op11_codes,
    "op12_markov": op12_markov,
    "op13_yinyang": op13_yinyang,
}

ORACLE_SQL: dict[str, str] = {
    "op3_decontaminate": decontaminate.ORACLE_SQL,
    "op11_codes": codes.ORACLE_SQL,
    "op13_yinyang": yinyang.ORACLE_SQL,
}
