"""A training-data pipeline over `documents`.

Quality classifier, quality rules, near-duplicates, repeated passages, packing.
Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes it
to the shared folder and rereads it as the next stage's documents. All stages
but the last return the columns of `documents`; other columns pass through the
first three. Nulls, empty texts, repeated rows and empty tables are handled as
the operators state; a null or empty text fails the quality rules.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isohyet.llm import hyperminhash, risk_thresholds, subword_embedding, suffix_dedup, sumsquares_packing
from isohyet.llm.queries import tokenizer_path
from isohyet.llm.texts import discard, scratch, settled, table, workspace

#: Word shingles of the near-duplicate stage, and the least similarity in percent.
SHINGLE, PERCENT = 5, 80
#: Bytes of a repeated passage.
PASSAGE = 200

# No SQL: the first stage trains a model.
ORACLE_SQL = None


def own_tables(stage: Callable) -> Callable:
    """A stage that keeps the tables of its operator to itself and removes those of the stage before, whose result is stored by now."""
    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        with workspace(spark, docs):
            return stage(spark, docs, sf_dir)

    return run_stage


@own_tables
def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for good ones."""
    return subword_embedding.kept_rows(docs, subword_embedding.fit(docs, table(spark, sf_dir, "labels")))


@own_tables
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule rejects."""
    return risk_thresholds.kept_rows(docs, table(spark, sf_dir, "labels"))


@own_tables
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of rows with similar texts: one with the smallest id. Rows without an id stay."""
    # A stored key of each row stands for its id: different texts of one id are different documents.
    rows = settled(docs.select(F.monotonically_increasing_id().alias("_key"), F.struct(*docs.columns).alias("_row")))
    known = rows.filter(F.col("_row.doc_id").isNotNull())
    texts = known.select("_key", F.col("_row.text").alias("text"))
    groups = hyperminhash.near_duplicates(texts, SHINGLE, PERCENT, id_col="_key").select(F.col("doc_id").alias("_key"), "component_id")
    ids = known.select("_key", F.col("_row.doc_id").alias("doc_id"))
    kept = groups.join(ids, "_key").groupBy("component_id").agg(F.min(F.struct("doc_id", "_key")).alias("first")).select("first._key")
    alone = rows.filter(F.col("_row.doc_id").isNull())
    return known.join(kept, "_key", "left_semi").unionByName(alone).select("_row.*")


@own_tables
def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that stand elsewhere too; documents of which no word is left go."""
    others = tuple(c for c in docs.columns if c not in ("text", "n_chars"))
    rows = suffix_dedup.kept_texts(docs, others, PASSAGE).filter(F.col("kept_text").rlike(r"[^\x20\x09-\x0D]"))
    new = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    return rows.select(*[new.get(c, F.col("_row")[c]).alias(c) for c in docs.columns])


@own_tables
def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequences."""
    return sumsquares_packing.pack_documents(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", quality_rules),
    ("near-duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("best-fit packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES:
        before, folder = folder, scratch(spark)
        docs = settled(stage(spark, docs, sf_dir), folder)
        if before:
            discard(spark, before)
    return docs
