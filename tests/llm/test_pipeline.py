"""The pipeline on the smallest tables: every stage against what it must keep and drop."""

import random
import re

from pyspark.sql import functions as F

import corpus_pipeline
from isohyet.llm import hyperminhash
from isohyet.llm.texts import settled
from tests.llm.common import LOWER, SF, WORD, needs_tables, path, sentences
from tests.llm.test_edges import LABELS, clashing


@needs_tables
def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = settled(stage(spark, docs, SF))
        seen[name] = docs
    assert all(seen[n].columns == columns for n in list(seen)[:-1])
    counts = [seen[n].count() for n in list(seen)[:-1]]
    assert counts == sorted(counts, reverse=True) and 0 < counts[-1] < spark.read.parquet(f"{SF}/documents.parquet").count()

    labels = spark.read.parquet(f"{SF}/labels.parquet")
    assert seen["quality classifier"].join(labels.filter("quality = 0"), "doc_id").count() <= 1
    # Near-duplicates: no two kept texts are similar.
    sets = []
    for r in seen["near-duplicates"].select("text").collect():
        w = WORD.findall(r["text"].translate(LOWER))
        n = min(5, len(w))
        sets.append({tuple(w[i:i + n]) for i in range(len(w) - n + 1)})
    for i, a in enumerate(sets):
        for b in sets[:i]:
            if min(len(a), len(b)) >= 0.8 * max(len(a), len(b)):
                assert len(a & b) < 0.8 * len(a | b)
    # Passages: no string of 200 bytes is left twice, but where a removal has joined two ends.
    before = {r["doc_id"]: r["text"] for r in seen["near-duplicates"].collect()}
    after = {r["doc_id"]: r for r in seen["repeated passages"].collect()}
    starts = {}
    for text in before.values():
        data = text.encode()
        for p in range(len(data) - 199):
            starts[data[p:p + 200]] = starts.get(data[p:p + 200], 0) + 1
    for doc_id, r in after.items():
        assert r["n_chars"] == len(r["text"]) and re.search(r"\S", r["text"])
        data = before[doc_id].encode()
        if all(starts[data[p:p + 200]] == 1 for p in range(len(data) - 199)):
            assert r["text"] == before[doc_id]
    packed = seen["best-fit packing"]
    assert {r["doc_id"] for r in packed.select("doc_id").collect()} == set(after)


@needs_tables
def test_near_duplicate_stage_is_the_operator(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {r["doc_id"] for r in hyperminhash.near_duplicates(docs, 5, 80).filter("kept").collect()}
    assert {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect()} == kept


def test_rows_with_null_and_repeated_ids_keep_their_own_texts(spark, monkeypatch):
    rnd = random.Random(9)
    one, two, three, four, shared = (sentences(rnd, 60) for _ in range(5))
    rows = [(None, one, "p"), (None, two, "q"), (7, three, "r"), (7, four, "s"), (7, four, "s"), (9, three + " tail", "t"), (8, shared, "u"), (None, shared, "v")]
    docs = clashing(spark.createDataFrame(rows, "doc_id long, text string, own string")).withColumns({"_key": F.lit("y"), "kept_text": F.lit("y")})
    columns = docs.columns

    def of(df):
        assert df.columns == columns
        return sorted((str(r["doc_id"]), r["text"], r["own"], r["_row"], r["_key"]) for r in df.collect())

    def want(*which):
        return sorted((str(rows[i][0]), rows[i][1], rows[i][2], "x", "y") for i in which)

    monkeypatch.setattr(corpus_pipeline, "table", lambda *_: spark.createDataFrame([], LABELS))
    # Without labels every document scores 0.5.
    assert of(corpus_pipeline.quality_classifier(spark, docs, "")) == want(*range(8))
    assert of(corpus_pipeline.quality_rules(spark, docs, "")) == want(*range(8))
    single = settled(corpus_pipeline.near_duplicates(spark, docs, ""))
    assert of(single) == want(0, 1, 2, 3, 6, 7)
    assert of(corpus_pipeline.repeated_passages(spark, single, "")) == want(0, 1, 2, 3)
    lengths = [r["n_chars"] for r in corpus_pipeline.repeated_passages(spark, single, "").collect()]
    assert sorted(lengths) == sorted(map(len, (one, two, three, four)))
    monkeypatch.setattr(corpus_pipeline, "tokenizer_path", path)
    packed = corpus_pipeline.best_fit_packing(spark, single, "").collect()
    assert sorted(str(r["doc_id"]) for r in packed if r["piece"] == 0) == ["7", "7", "8", "None", "None", "None"]


def test_a_stage_removes_the_tables_of_the_one_before(spark, tmp_path):
    """Its own stay until its result is stored, also where two stages follow each other without that."""
    import os

    from isohyet.llm import texts
    from isohyet.session import checkpoint_dir

    docs = spark.createDataFrame([(i, f"text {i}", "en", "s", 6) for i in range(5)], "doc_id long, text string, lang string, source string, n_chars long")
    folder = checkpoint_dir(spark).split(":", 1)[-1]
    stages = lambda: {f for f in os.listdir(folder) if f.startswith("isohyet-stage-")}

    def step(source):
        with texts.workspace(spark, source):
            return texts.settled(source)

    step(docs)
    before = stages()
    one = step(docs)
    assert not before & stages() and len(stages()) == 1
    two = step(one)  # reads what the first stored: nothing may go yet
    assert len(stages()) == 2 and two.count() == 5
    two.write.parquet(str(tmp_path / "stored"))
    three = step(spark.read.parquet(str(tmp_path / "stored")))
    assert len(stages()) == 1 and three.count() == 5
    assert "isohyet-stage-" not in texts.scratch(spark)


LONG = " ".join(f"word{i} is number {i * 7919 % 104729}" for i in range(40_000))
ODD = [(1, "plain words that stand in this text and nowhere else at all"), (2, None), (3, ""), (4, " \n\t"), (None, "a text without an id has words too, and more of them"), (5, LONG),
       (6, "日本語 " * 200), (1, "plain words that stand in this text and nowhere else at all")]


def _tables(spark, monkeypatch):
    monkeypatch.setattr(corpus_pipeline, "table", lambda *_: spark.createDataFrame([], LABELS))
    monkeypatch.setattr(corpus_pipeline, "tokenizer_path", path)
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    return lambda rows: spark.createDataFrame([(d, t, "en", None, None if t is None else len(t)) for d, t in rows], schema)


def test_stages_on_odd_rows(spark, monkeypatch):
    """Null, empty, blank and very long texts, a null id and a repeated row, in every stage."""
    docs = _tables(spark, monkeypatch)(ODD)
    got = {}
    for name, stage in corpus_pipeline.STAGES:
        rows = stage(spark, docs, "").collect()
        got[name] = sorted((str(r["doc_id"]) for r in rows), key=str)
        if name != "best-fit packing":
            assert rows[0].asDict().keys() == set(docs.columns)
    assert got["quality classifier"] == sorted(str(d) for d, _ in ODD)  # no labels: every document scores 0.5
    # Fewer than ten words, or a text that repeats itself, fails the base rules.
    assert got["quality rules"] == ["1", "1", "5", "None"]
    assert got["near-duplicates"] == ["1", "2", "3", "4", "5", "6", "None"]
    # The text that repeats itself is removed whole; texts without a word go.
    assert got["repeated passages"] == ["1", "1", "5", "None"]
    assert {*got["best-fit packing"]} == {"1", "2", "3", "4", "5", "6", "None"}


def test_stages_on_an_empty_table(spark, monkeypatch):
    docs = _tables(spark, monkeypatch)([])
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, "")
        assert out.count() == 0, name
        assert name == "best-fit packing" or out.columns == docs.columns


def test_run_is_its_stages_one_after_the_other(spark, monkeypatch):
    """Against a plain version of the last four stages; without labels the first keeps everything."""
    rnd = random.Random(12)
    shared = " ".join(f"s{rnd.randrange(10**6)}" for _ in range(60))
    rows = [(i, sentences(rnd, 40) + (f" {shared} tail{i}" if i in (3, 4) else "")) for i in range(8)]
    rows += [(20, rows[0][1]), (21, rows[1][1] + " more"), (22, "too short"), (23, None), (24, "again and again " * 30)]
    docs = _tables(spark, monkeypatch)(rows)
    labels = corpus_pipeline.table
    monkeypatch.setattr(corpus_pipeline, "table", lambda s, d, name: docs if name == "documents" else labels())

    def words(text):
        return WORD.findall((text or "").translate(LOWER))

    kept = []
    for d, text in rows:
        w = words(text)
        fives = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
        covered = {i + k for i, f in enumerate(fives) if fives.count(f) > 1 for k in range(5)}
        if len(w) >= 10 and 100 * len(covered) <= 20 * len(w):
            kept.append((d, text, set(fives)))
    single = [x for i, x in enumerate(kept) if not any(100 * len(x[2] & y[2]) >= 80 * len(x[2] | y[2]) for y in kept[:i])]
    data = [(d, t.encode()) for d, t, _ in single]
    starts = {}
    for _, b in data:
        for p in range(len(b) - 199):
            starts[b[p:p + 200]] = starts.get(b[p:p + 200], 0) + 1
    texts = {}
    for d, b in data:
        gone = {q for p in range(len(b) - 199) if starts[b[p:p + 200]] > 1 for q in range(p, p + 200)}
        texts[d] = bytes(x for q, x in enumerate(b) if q not in gone).decode()
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path("byte_bpe_50k.json"))
    want = {d: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for d, t in texts.items()}
    got = {r["doc_id"]: r["length"] for r in corpus_pipeline.run(spark, "").collect()}
    assert got == want and set(got) == {0, 1, 2, 3, 4, 5, 6, 7} and want[3] < len(tokenizer.encode(rows[3][1], add_special_tokens=False).ids)
