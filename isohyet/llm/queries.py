"""The numbered queries: each applies its operator to the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from isohyet.llm import (
    block_tree, bpe_transducer, conversation_repair, divergence_audit, hpyp, hyperminhash, oracles, pii_disclosure,
    risk_thresholds, rp_forest, subword_embedding, suffix_dedup,
    sumsquares_packing, token_counts,
)
from isohyet.llm.texts import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {
    "op1_embedding_near_dedup": oracles.EMBEDDINGS,
    "op6_suffix_dedup": oracles.PASSAGES,
    "op10_minhash_near_dedup": oracles.NEAR_DUPLICATES,
    "op12_conversation_repair": oracles.CONVERSATIONS,
    "op13_source_divergence": oracles.DIVERGENCE,
}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rp_forest.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_tree.extract(table(spark, sf_dir, "pages"))


@query
def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hpyp.score_texts(table(spark, sf_dir, "documents"))


@query
def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return subword_embedding.score(docs, subword_embedding.fit(docs, table(spark, sf_dir, "labels")))


@query
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


@query
def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(table(spark, sf_dir, "documents")).drop("kept_text")


@query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return risk_thresholds.apply_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op8_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_transducer.encode(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


@query
def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sumsquares_packing.pack_documents(
        table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json")
    )


@query
def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hyperminhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=2)


@query
def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_disclosure.find(table(spark, sf_dir, "documents"))


@query
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.audits(conversation_repair.damaged(table(spark, sf_dir, "conversations")))


@query
def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence_audit.audit(table(spark, sf_dir, "documents"))
