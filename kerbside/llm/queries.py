"""The registered queries: each applies one operator, with production parameters, to its whole table."""

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from . import (
    decontaminate,
    html_text,
    line_dedup,
    manifest,
    mixing,
    packing,
    paragraph_dedup,
    prefix_trie,
    quality,
    sharding,
    simhash,
    sql,
    suffix_dedup,
    toxicity,
)
from .common import table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_table(table(spark, sf_dir, "documents"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.report(table(spark, sf_dir, "documents"))


def op5_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraph_dedup.report(table(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.piece_table(table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.verify(table(spark, sf_dir, "documents"))


OPERATORS = (
    op1_toxicity, op2_mixture, op3_sharding, op4_suffix_dedup, op5_paragraph_dedup,
    op6_line_dedup, op7_decontamination, op8_simhash, op9_quality, op10_main_text,
    op11_packing, op12_prefix_trie, op13_manifest,
)
QUERIES = {f.__name__: f for f in OPERATORS}
QUERIES["pipeline"] = corpus_pipeline.run

SQL = {
    "op2_mixture": sql.MIXTURE,
    "op7_decontamination": sql.DECONTAMINATION,
    "op9_quality": sql.QUALITY,
    "op12_prefix_trie": sql.PREFIX_TRIE,
    "op13_manifest": sql.MANIFEST,
}
