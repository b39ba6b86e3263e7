"""Page extraction, classifier, rules and language model."""

import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest

from isohyet.llm import block_labels, block_tree, hpyp, hyperminhash, restaurants, risk_thresholds, subword_embedding
from isohyet.llm.texts import ascii_lower, words_of
from tests.llm.common import LOWER, SF, WORD, frame, needs_tables, sentences


@pytest.fixture(scope="module")
def tree(spark):
    return block_tree.fit_tree(spark, block_labels.labelled_blocks())


def test_tree_fits_its_labels_and_uses_neighbours(tree):
    rows = block_labels.labelled_blocks()
    assert all(block_tree.decide(tree, f) == label for f, label in rows)

    def used(node):
        return {node[0]} | used(node[2]) | used(node[3]) if isinstance(node, tuple) else set()

    assert used(tree) & {2, 3, 4, 5}


@pytest.mark.parametrize("page, text", [
    ("", ""), ("<p>", ""),
    ("<nav><a href='/'>Home page</a></nav><article><h1>One  two</h1><p>a <b>b</b>c\n d&amp;amp; &lt;e&gt;<br>f</p></article><footer>x</footer>",
     "One two a bc d&amp; <e> f"),
    ("<article><p>x<!-- y --><script>var a='</p>'</script></p><form><p>no</p></form><p>z", "x z"),
    ("<article><p>kept</p><div class='post-comments'><p>said</p></div><p>on</p><aside>no</aside></article>", "kept on"),
    ("<article><p>one <svg width='1' /> two</p><math/><p>three</p><svg><text>no</text></svg></article>", "one two three"),
    ("<article><datalist id='d'><option>no<option value='/'>no</datalist><p>one</p><select><option>no</select><p>two</p></article>", "one two"),
    ("<article><div><button>no</div><p>one <button><div>no</div></button> two</p></article>", "one two"),
    ("<article><p><option>no</p><p>one</p></article>", "one"),
    ("<div class='layout has-sidebar'><div class='with-comments no-ads'><article><p>one</p><p>two</p></article></div></div>", "one two"),
    ("<form class='page-header'><div class='social'><article><p>one</p></article></div></form>", "one"),
    ("<article><p>one</p></article><div class='comments'><article class='comment-body'><p>no</p></article></div>"
     "<aside><article><p>no</p></article></aside>", "one"),
    ("<div class='has-sidebar'><article class='post tag-social category-legal'><p>one</p></article></div>", "one"),
    ("<article><p title='a>b'>t</p><p>cut off <a href='x", "t cut off"),
])
def test_pages(tree, page, text):
    assert block_tree.main_text(page, tree)[0] == text


@pytest.mark.parametrize("page", ["<" * 50_000, '<a href="' * 9_000, "<!--" * 9_000, "<div>" * 9_000 + "x" + "</div>" * 9_000, "<svg /" * 9_000, "<option><div>" * 9_000, '<p "' * 9_000])
def test_broken_pages_take_linear_time(tree, page):
    block_tree.main_text(page, tree)


@needs_tables
def test_given_pages(spark, tree):
    import html

    got = block_tree.extract(spark.read.parquet(f"{SF}/pages.parquet"), tree)
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in got.collect():
        inner = re.search(r"<article>(.*?)(</article>|\Z)", pages[r["page_id"]], re.S)[1]
        want = " ".join(html.unescape(re.sub(r"</?(?:p|h1|br)>", " ", re.sub(r"</?b>", "", inner))).split())
        assert r["text"] == want and r["n_chars"] == len(want)


@needs_tables
def test_classifier_on_held_out_labels(spark):
    folder = SF.replace("0.001", "0.01")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    scored = subword_embedding.score(docs, subword_embedding.fit(docs, labels))
    rows = scored.join(labels, "doc_id").filter("held_out and quality is not null").collect()
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    assert len(rows) > 50 and np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.95


def test_classifier_without_labels_or_with_one_class(spark):
    docs = frame(spark, [(1, "a b"), (2, "")])
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r["score"] for r in subword_embedding.score(docs, subword_embedding.fit(docs, none)).collect()] == [0.5, 0.5]
    one = spark.createDataFrame([(1, 1), (2, 1), (3, None), (3, 7)], "doc_id long, quality int")
    assert all(r["score"] > 0.5 for r in subword_embedding.score(docs, subword_embedding.fit(docs, one)).collect())


def brute_counts(text):
    w = WORD.findall(text)
    windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    times = Counter(windows)
    covered = {j for i, k in enumerate(windows) if times[k] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return [len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)]


def test_rule_counts():
    rnd = random.Random(1)
    texts = ["", "a b a b a b a b a b a b", "x y z w v\nx y z w v\n\n \n x", "\x1ca b\x1c c", "#|<>  **"]
    texts += [" ".join(rnd.choice("abc#") + rnd.choice(["", "\n", " "]) for _ in range(rnd.randrange(60))) for _ in range(80)]
    got = list(zip(*risk_thresholds.counts_of(texts)))
    assert [list(g[:5]) for g in got] == [brute_counts(t) for t in texts]


def test_binomial_bound_is_exact():
    for k, n, p in ((0, 100, 0.01), (3, 500, 0.01), (7, 20, 0.3)):
        want = sum(math.comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(k + 1))
        assert risk_thresholds.at_most(k, n, p) == pytest.approx(want, rel=1e-9)


def test_cutoffs_are_certified_and_tested_in_order():
    cutoffs = (3.0, 2.0, 1.0)
    choose = risk_thresholds.choose_cutoff
    assert choose(1000, 50, [0, 0, 30], [10, 40, 50], cutoffs, 0.01, 0.005) == 2.0
    assert choose(1000, 50, [30, 0, 0], [10, 40, 50], cutoffs, 0.01, 0.005) is None  # the mildest fails
    assert choose(100, 50, [0, 0, 0], [10, 40, 50], cutoffs, 0.01, 0.005) is None  # too few labels
    assert choose(1000, 0, [0, 0, 0], [0, 0, 0], cutoffs, 0.01, 0.005) is None  # nothing to gain


def test_rules_per_stratum(spark):
    rnd = random.Random(5)
    rows, labels = [], []
    for i in range(1600):
        bad = i % 8 == 0
        words = sentences(rnd, 40).split(" ")
        rows.append((i, " ".join(w + "#$%" if bad else w for w in words), "en" if i < 1500 else "fr"))
        labels.append((i, 0 if bad else 1, 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = risk_thresholds.apply_rules(docs, spark.createDataFrame(labels, "doc_id long, quality int, kept int")).collect()
    for r in got:
        bad = r["doc_id"] % 8 == 0
        assert not r["base_failed"] and r["kept"] == (not bad or r["doc_id"] >= 1500)  # few labels: nothing rejected


def test_seating_has_the_right_equilibrium():
    """One dish with three customers: the share of each number of tables against the exact one."""
    rng, d, a, n = np.random.default_rng(1), 0.4, 0.7, 40_000
    size, owner = np.full(n, 3), np.arange(n)
    weight = np.full(n, a)
    for _ in range(8):
        size, owner = restaurants.sweep(rng, size, owner, weight, d, 3)
    assert np.bincount(owner, weights=size).tolist() == [3] * n
    exact = np.array([a * (1 - d) * (2 - d), 3 * a * a * (1 - d), a ** 3])
    share = np.bincount(np.bincount(owner), minlength=4)[1:] / n
    assert np.abs(share - exact / exact.sum()).max() < 0.01


def test_first_seating_and_changes_keep_customers():
    rng = np.random.default_rng(2)
    customers = np.array([1, 2, 5, 1000, 100_000])
    size, owner = restaurants.first_seating(rng, customers, np.array([0.5, 1, 2, 3, 400.0]), 0.7)
    assert np.bincount(owner, weights=size).tolist() == customers.tolist() and size.min() > 0
    size, owner = restaurants.add(rng, size, owner, np.array([0, 3]), np.full(5, 1.0), 0.7)
    size, owner = restaurants.remove(rng, size, owner, np.array([2, 4]))
    assert np.bincount(owner, weights=size).tolist() == [2, 2, 4, 1001, 99_999]


def test_whole_sweeps_have_the_right_equilibrium():
    """Dishes of 3 and of 100 customers (more than the steps of a sweep): the mean number of tables against the exact one."""
    rng, d = np.random.default_rng(1), 0.5
    for n, a, m, rounds in ((3, 0.7, 20_000, 8), (100, 1.5, 2_000, 40)):
        ways = np.zeros(n + 2)
        ways[1] = 1
        for i in range(1, n):
            ways = np.r_[0, ways[:-1]] + (i - d * np.arange(n + 2)).clip(0) * ways
        p = ways * a ** np.arange(n + 2.0)
        size, owner = np.full(m, n), np.arange(m)
        for _ in range(rounds):
            size, owner = restaurants.sweep_all(rng, size, owner, np.full(m, a), d)
        assert np.bincount(owner, weights=size).tolist() == [n] * m and (np.diff(owner) >= 0).all()
        assert len(size) / m == pytest.approx((np.arange(n + 2) * p).sum() / p.sum(), rel=0.03)
    assert [len(x) for x in restaurants.sweep_all(rng, size[:0], owner[:0], np.empty(0), d)] == [0, 0]


def test_a_round_reseats_every_customer(monkeypatch):
    """A hot dish at one table, beside one that is alone: far more than a few of its customers move."""
    monkeypatch.setattr(restaurants, "RUN", 1_000)
    full = np.full(hpyp.CLASSES, 5_000)
    levels = hpyp.Levels(0.5, 0.5, 2, full, np.full(hpyp.CLASSES, 500), 1_000.0, 2.0)
    state = {"word": np.array([0, 1]), "classes": np.array([0, 0]), "n": np.array([5_000, 2]), "singles": np.array([900, 0]),
             "size": np.array([5_000, 2]), "tables": np.array([1, 1]), "parent_size": np.array([901, 1]), "parent_tables": np.array([1, 1])}
    out = hpyp.gibbs_round(state, levels, 0, 0, True)
    assert out["tables"][0] > 50 and out["size"].sum() == 5_002
    assert out["parent_size"].sum() == 900 + out["tables"].sum()


def test_words_are_hashed_as_bytes(monkeypatch):
    """Whole texts at once, as word by word: only A-Z in lower case, only six characters of white space, in any pieces."""
    texts = ["", " ", "Ä ß\x0bA\x85b\xa0\x1cİI\tx\r\n\x0cy", "Q", " W ", "", "\u2028Z 世界 " + "LONG" * 40, "a", "B c"] * 3
    words = [words_of(ascii_lower(t)) for t in texts]
    want = hyperminhash.word_hashes([w for ws in words for w in ws])
    for piece in (1, 7, 1 << 18):
        monkeypatch.setattr(hpyp, "PIECE", piece)
        hashed, sizes = hpyp.token_hashes([t.encode() for t in texts])
        assert hashed.tolist() == want.tolist() and sizes.tolist() == [len(ws) for ws in words]
    assert [len(x) for x in hpyp.token_hashes(["".encode(), b" \n"])] == [0, 2]


def test_tokens_take_no_python_step_each():
    """Texts outside ASCII were most of the query's time: lower-cased, split and numbered as strings."""
    rnd = random.Random(4)
    texts = [" ".join("ä" + rnd.choice("abcÉ") * rnd.randrange(1, 6) for _ in range(40_000)) for _ in range(10)]
    coded = [t.encode() for t in texts]

    def seconds(run):
        began = time.process_time()
        run()
        return time.process_time() - began

    assert min(seconds(lambda: hpyp.token_hashes(coded)) for _ in range(3)) < 0.5 * min(
        seconds(lambda: [words_of(ascii_lower(t)) for t in texts]) for _ in range(3))


def test_pairs_sort_alike_with_and_without_room_for_documents():
    rng = np.random.default_rng(3)
    key, doc = rng.integers(0, 50, 2_000), np.sort(rng.integers(0, 9, 2_000))
    for shift in (0, 57):
        got = hpyp.by_key(key << shift, doc)
        want = sorted(zip((key << shift).tolist(), doc.tolist()))
        assert list(zip(*(x.tolist() for x in got))) == want


def test_scoring_tasks_get_one_shard_each(spark):
    rows = spark.createDataFrame([(s, b) for s in range(40) for b in (2, None, 1)], "shard int, block long")
    parts = hpyp.by_shard(rows, 40).rdd.glom().collect()
    assert [[tuple(r) for r in p] for p in parts] == [[(s, None), (s, 1), (s, 2)] for s in range(40)]


@pytest.fixture(scope="module")
def language(spark):
    rnd = random.Random(9)
    follow = {f"w{i}": [f"w{rnd.randrange(60)}" for _ in range(4)] for i in range(60)}
    rows = []
    for i in range(400):
        w = ["w0"]
        for _ in range(rnd.randrange(60)):
            w.append(rnd.choice(follow[w[-1]]) if rnd.random() < 0.95 else f"rare{rnd.randrange(500)}" if rnd.random() < 0.3 else f"w{rnd.randrange(60)}")
            follow.setdefault(w[-1], ["w1"])
        rows.append((i, " ".join(w).title() if i % 2 else "\t".join(w)))
    rows += [(1000, None), (1001, ""), (None, "w1 w2"), (7, "w1")]
    return rows, hpyp.score_texts(frame(spark, rows), shard_bytes=8_000, block_chars=20_000).collect()


def test_language_model_counts_and_perplexity(language):
    rows, got = language
    tokens = [(i, WORD.findall((t or "").translate(LOWER)) + ["</s>"]) for i, t in rows]
    count = Counter()
    for i, w in tokens:
        if i is None or zlib.crc32(str(i).encode()) % 10:
            count.update(w)
    n, v = sum(count.values()), len(count)
    want = sorted((str(i), len(w), sum(count[x] > 0 for x in w), n, round(sum(math.log10((count[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w), 6))
                  for i, w in tokens)
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == want
    held = [r for r in got if r["held_out"]]
    assert held and sum(r["score"] for r in held) > 0.75 * sum(r["base_score"] for r in held)


def test_probabilities_of_a_context_add_up_to_one(spark):
    docs = frame(spark, [(i, "a b c a b d " * 3 + f"x{i % 7} y") for i in range(60)])
    texts = docs
    blocks = hpyp.settled(hpyp.blocks_of(texts, 2, 10_000))
    counted = hpyp.settled(hpyp.counts_by_shard(blocks))
    state, samples, _, words = hpyp.sample_seating(counted, 2)
    models = {r["shard"]: r for r in counted.join(state.withColumnRenamed("state", "seats"), "shard").collect()}
    from isohyet.llm.hyperminhash import word_hashes

    for before in ("a", "b", "y", "never"):
        context = int(word_hashes([before])[0] & np.uint64(hpyp.CLASSES - 1))
        total = 0.0
        for k, r in enumerate(models.values()):
            scorer = hpyp.Scorer(r["table"], r["seats"], samples)
            asked = np.r_[scorer.words, np.uint64(1)] if k == 0 else scorer.words  # one unknown word
            asked = np.sort(asked)
            places = hpyp.pack(words=asked, per_word=np.ones(len(asked), np.int64), classes=np.full(len(asked), context, np.uint16),
                               times=np.ones(len(asked), np.int64), doc=np.arange(len(asked)), n_docs=np.array([len(asked)]))
            total += (10 ** scorer.score(places)[0]).sum()
        assert total == pytest.approx(1.0, abs=1e-9), before
