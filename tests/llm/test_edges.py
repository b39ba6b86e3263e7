"""Nulls, empty and long texts, repeated rows, empty tables and clashing columns, for every operator."""

import pytest
from pyspark.sql import functions as F

from isohyet.llm import (
    block_tree, bpe_transducer, hpyp, hyperminhash, risk_thresholds, rp_forest, subword_embedding, suffix_dedup,
    sumsquares_packing, token_counts,
)
from tests.llm.common import frame, path

LABELS = "doc_id long, quality int, toxic int, text string, score double"
OPERATORS = {
    "lm": lambda d, labels: hpyp.score_texts(d),
    "classifier": lambda d, labels: subword_embedding.score(d, subword_embedding.fit(d, labels)),
    "counts": lambda d, labels: token_counts.token_counts(d, path("piece_bpe_32k.model")),
    "passages": lambda d, labels: suffix_dedup.dedup(d),
    "rules": lambda d, labels: risk_thresholds.apply_rules(d, labels),
    "transducer": lambda d, labels: bpe_transducer.encode(d, path("word_bpe_49k.json"), max_words=5),
    "packing": lambda d, labels: sumsquares_packing.pack_documents(d, path("byte_bpe_50k.json")),
    "near": lambda d, labels: hyperminhash.near_duplicates(d),
}
LONG = "word " * 60_000
ROWS = [(1, "a b c d e f g h i j k l"), (1, "a b c d e f g h i j k l"), (2, None), (3, ""), (None, "null id here"), (4, LONG), (5, "日本 " * 300),
        (6, "x" * 20_000)]


def clashing(df):
    """Columns with the names that operators use for their own."""
    names = ("lang", "source", "n_chars", "score", "predicted", "label", "kept", "component", "component_id", "length", "offset", "piece",
             "sequence_id", "rep", "key", "_id", "_row", "id", "a", "b", "n_tokens", "found", "place", "shard", "block")
    return df.withColumns({n: F.lit("x") for n in names})


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows(spark, name):
    docs = clashing(frame(spark, ROWS))
    labels = spark.createDataFrame([(1, 1, 0, "t", 0.5), (1, 0, 0, "t", 0.5), (None, 1, 0, "t", 0.5), (4, None, 0, "t", 0.5), (9, 1, 1, "t", 0.5)], LABELS)
    rows = OPERATORS[name](docs, labels).collect()
    ids = [r["doc_id"] for r in rows]
    if name == "packing":
        assert {*ids} == {1, 2, 3, 4, 5, 6, None}
        assert sum(r["piece"] == 0 for r in rows) == len(ROWS)  # every row is a document of its own
        assert all(r["length"] == 1 for r in rows if r["doc_id"] in (2, 3))
        return
    assert sorted(map(str, ids)) == sorted(str(i) for i, _ in ROWS)
    first, second = (r for r in rows if r["doc_id"] == 1)
    assert first == second
    of = {r["doc_id"]: r for r in rows}
    if name == "counts":
        assert (of[2]["n_bytes"], of[2]["n_tokens"], of[3]["n_tokens"], of[4]["over_limit"]) == (0, 0, 0, True)
    if name == "passages":
        assert of[2]["n_bytes"] == of[3]["n_removed"] == 0 and of[4]["n_removed"] == len(LONG) and of[6]["n_removed"] == 20_000
    if name == "rules":
        assert of[2]["base_failed"] and not of[2]["kept"] and of[4]["base_failed"] and of[1]["kept"]
    if name == "transducer":
        assert of[2]["n_tokens"] == 0 and of[2]["ids_sha256"] == of[3]["decoded_sha256"]
    if name == "near":
        assert of[2]["n_shingles"] == 0 and of[2]["component_id"] == 2 and of[4]["n_shingles"] == 1 and of[None]["kept"]
    if name == "classifier":
        assert of[2]["score"] == of[3]["score"] and not of[None]["held_out"]


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_tables(spark, name):
    assert OPERATORS[name](frame(spark, []).withColumn("lang", F.lit("x")), spark.createDataFrame([], LABELS)).count() == 0


def test_odd_pages_and_vectors(spark):
    pages = spark.createDataFrame([(1, "u", None, "x"), (1, "u", None, "x"), (None, None, "<p>a", "y"), (2, "u", "", "z")],
                                  "page_id long, url string, html string, text string")
    rows = block_tree.extract(pages, 1).collect()
    assert sorted((str(r["page_id"]), r["text"], r["n_chars"]) for r in rows) == [("1", "", 0), ("1", "", 0), ("2", "", 0), ("None", "a", 1)]
    assert block_tree.extract(pages.limit(0), 1).count() == 0
    vectors = spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [1.0, 0.0]), (2, [1e-30, 1e-32]), (3, [1e300, 1e300])],
                                    "vec_id long, embedding array<double>").withColumn("component", F.lit(1)).withColumn("rep", F.lit(2))
    rows = sorted((str(r["vec_id"]), r["n_links"], r["component_id"], r["kept"]) for r in rp_forest.near_duplicates(vectors).collect())
    assert rows == [("1", 2, 1, True), ("1", 2, 1, True), ("2", 2, 1, False), ("3", 0, 3, True), ("None", 0, None, True)]
    assert rp_forest.near_duplicates(vectors.limit(0)).count() == 0
