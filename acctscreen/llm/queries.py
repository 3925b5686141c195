"""The registered queries of this package: each applies its operator, with
production parameters, to its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from acctscreen.llm import op1_secrets, op2_mixing, op3_brown, op4_toxicity, op5_lshforest, op6_sharding, op7_warc, op8_decontaminate, op9_langid, op10_topk, op11_collocations, op12_trie, op13_licenses
from acctscreen.llm.common import table
from acctscreen.llm.oracle import ORACLE

Query = Callable[[SparkSession, str], DataFrame]


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op1_secrets.secret_digest(table(spark, sf_dir, "documents"))


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op2_mixing.mix_plan(table(spark, sf_dir, "documents"))


def op3_brown_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op3_brown.score_texts(table(spark, sf_dir, "documents"))


def op4_toxicity_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op4_toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_lsh_forest_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op5_lshforest.near_duplicates(table(spark, sf_dir, "documents"))


def op6_slot_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op6_sharding.shard_rows(table(spark, sf_dir, "documents"))


def op7_warc_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op7_warc.archive_pages(table(spark, sf_dir, "pages"))


def op8_latent_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op8_decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op9_langid.identify_corpus(table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages"))


def op10_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op10_topk.top_k(table(spark, sf_dir, "embeddings"))


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op11_collocations.collocations(table(spark, sf_dir, "documents"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op12_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op13_licenses.license_digest(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_secret_scan,
        op2_source_mix,
        op3_brown_lm,
        op4_toxicity_lexicon,
        op5_lsh_forest_join,
        op6_slot_sharding,
        op7_warc_roundtrip,
        op8_latent_decontamination,
        op9_language_id,
        op10_exact_topk,
        op11_phrase_collocations,
        op12_conversation_trie,
        op13_license_scan,
    )
}
ORACLE_SQL = {k: v for k, v in ORACLE.items() if k in QUERIES}
