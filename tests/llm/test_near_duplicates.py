"""Near-duplicates, embeddings, passages and components against brute force."""

import hashlib
import random

import numpy as np
import pytest

from isohyet.llm import hyperminhash, rp_forest, suffix_dedup, suffix_sort
from isohyet.llm.components import components
from tests.llm.common import LOWER, WORD, Sets, frame, sentences


def near_copies(seed=1):
    rnd = random.Random(seed)
    texts = []
    for k in range(25):
        words = sentences(rnd, rnd.choice([3, 6, 12, 60, 150])).split(" ")
        texts.append(" ".join(words))
        for _ in range(rnd.randrange(6)):  # a chain: each copy changes the one before
            words = list(words)
            for _ in range(1 + len(words) // 40):
                words[rnd.randrange(len(words))] = f"new{rnd.randrange(1000)}"
            texts.append(" ".join(words))
    texts += [texts[3]] * 3 + ["One", "one", "ONE two", "one two", "", " \n"]
    rnd.shuffle(texts)
    return texts


@pytest.mark.parametrize("shingle", [2, 5])
def test_documents_against_all_pairs(spark, shingle):
    texts = near_copies()
    sets = []
    for t in texts:
        w = WORD.findall(t.translate(LOWER))
        n = min(shingle, len(w))
        sets.append({tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if n else set())
    groups = Sets(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= 80 * (len(a) + len(sets[j]) - both):
                groups.join(i, j)
    got = hyperminhash.near_duplicates(frame(spark, list(enumerate(texts))), shingle).collect()
    assert len(got) == len(texts)
    for r in got:
        i = r["doc_id"]
        assert (r["n_shingles"], r["component_id"], r["kept"]) == (len(sets[i]), groups.root(i), groups.root(i) == i)


def test_one_id_with_several_texts_has_the_links_of_all(spark):
    rnd = random.Random(5)
    one, two, three = (sentences(rnd, 80) for _ in range(3))
    rows = [(7, one), (7, two), (7, ""), (8, one + " tail"), (9, two + " tail"), (3, three), (None, one), (None, two)]
    got = sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in hyperminhash.near_duplicates(frame(spark, rows)).collect()), key=str)
    assert got == [(3, 3, True), (7, 7, True), (7, 7, True), (7, 7, True), (8, 7, False), (9, 7, False), (None, None, True), (None, None, True)]


def test_registers_estimate_similarity():
    rng = np.random.default_rng(4)
    sketch, pool = hyperminhash.Sketch(), rng.integers(0, 1 << 63, 3000).astype(np.uint64) * np.uint64(2)
    for size, common in ((2000, 1000), (300, 280), (40, 40)):
        a, b = np.unique(pool[:size]), np.unique(np.r_[pool[:common], pool[size:2 * size - common]])
        truth = common / (2 * size - common)
        equal = (sketch.registers(a) == sketch.registers(b)).sum()
        guess = hyperminhash.estimate(np.array([equal]), np.array([size]), np.array([size]))[0]
        assert abs(guess - truth) < 0.15


def test_register_is_leading_zeros_and_mantissa():
    sketch = hyperminhash.Sketch(1)
    low = np.uint64(0b1011 << 56)  # bucket 0; behind the bucket bit: 3 zeros, a one, then 011
    high = np.uint64((1 << 63) | (1 << 62))  # bucket 1: no zeros, then zeros
    value = sketch.registers(np.sort(np.array([low, high])))
    assert (value >> 10).tolist() == [3, 0] and (value & 1023).tolist() == [0b0110000000, 0]


def test_vectors_against_all_pairs(spark):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((40, 16))
    rows = [v + rng.standard_normal(16) * s for v in base for s in (0, 0.05, 0.15, 0.3)] + [base[0]] * 5 + [3 * base[1]]
    rows = [list(map(float, r)) for r in rows]
    bad = [None, [], [0.0] * 16, [float("nan")] + [1.0] * 15, [float("inf")] * 16, [None] + [1.0] * 15, [1.0, 2.0]]
    table = spark.createDataFrame([(i, v, "x") for i, v in enumerate(rows + bad)], "vec_id long, embedding array<double>, vector string")
    unit = np.array(rows) / np.linalg.norm(rows, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    groups = Sets(range(len(rows) + len(bad)))
    for i, j in zip(*np.nonzero(np.triu(near, 1))):
        groups.join(int(i), int(j))
    for r in rp_forest.near_duplicates(table).collect():
        i = r["vec_id"]
        links = int(near[i].sum()) - 1 if i < len(rows) else 0
        assert (r["n_links"], r["component_id"], r["kept"]) == (links, groups.root(i), groups.root(i) == i)


def test_deep_trees_find_the_links():
    rng = np.random.default_rng(3)
    x = rng.standard_normal((6000, 32))
    x[3000:] = x[:3000] + 0.25 * rng.standard_normal((3000, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = {(i, i + 3000) for i in range(3000) if x[i] @ x[i + 3000] >= 0.9}
    found = set()
    for tree in range(rp_forest.TREES):
        for a, b in rp_forest.cell_stars(x, x, np.arange(6000), tree, 1, 0.9):
            found |= {(min(p), max(p)) for p in zip(a.tolist(), b.tolist())}
    assert found <= near | found and len(near - found) <= 0.002 * len(near)


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 180)] + [(179, 300), (5, 5), (300, 179)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(61)} | {i: 100 for i in [*range(100, 180), 300]}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def passages(seed=7):
    rnd = random.Random(seed)
    shared = [sentences(rnd, 60) + " é日" for _ in range(5)]
    texts = []
    for _ in range(60):
        parts = [sentences(rnd, rnd.randrange(40))]
        for _ in range(rnd.randrange(3)):
            p = rnd.choice(shared)
            a = rnd.randrange(80)
            parts += [p[a:a + rnd.choice([150, 195, 199, 200, 201, 230, 400])], sentences(rnd, rnd.randrange(20))]
        texts.append(" ".join(parts))
    return texts + [texts[0], "a" * 450, "ab" * 150, "", "x" * 199, "q" * 200, shared[0] + shared[0]]


def brute_passages(texts, length):
    data = [t.encode() for t in texts]
    seen, again = set(), set()
    for b in data:
        for p in range(len(b) - length + 1):
            (again if b[p:p + length] in seen else seen).add(b[p:p + length])
    out = []
    for b in data:
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            if b[p:p + length] in again:
                gone[p:p + length] = True
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out.append((len(b), int(gone.sum()), int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("length", [200, 90])
def test_passages_against_all_substrings(spark, length):
    texts = passages()
    want = brute_passages(texts, length)
    for r in suffix_dedup.dedup(frame(spark, list(enumerate(texts))), length).collect():
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == want[r["doc_id"]], r["doc_id"]


def test_passages_of_many_rows_without_an_id(spark):
    rnd = random.Random(11)
    shared = sentences(rnd, 60)
    texts = [sentences(rnd, 60) + (shared if i % 10 == 0 else "") for i in range(600)]
    want = brute_passages(texts, 200)
    rows = [(None, t) for t in texts]
    got = suffix_dedup.dedup(frame(spark, rows), 200).select("n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(want)


@pytest.mark.parametrize("broken", [False, True])
def test_suffix_sort_is_right_even_with_colliding_hashes(broken, monkeypatch):
    rng = np.random.default_rng(1)
    raw = rng.integers(97, 99, 3000).astype(np.uint8)
    begin = rng.integers(0, 2900, 400)
    length = rng.integers(0, 100, 400)
    group = np.sort(rng.integers(0, 7, 400))
    hashes = suffix_sort.Hashes(raw)
    if broken:  # a hash that takes all bytes for equal
        monkeypatch.setattr(suffix_sort.Hashes, "of", lambda self, b, n: np.zeros(len(b), np.uint64) + np.asarray(n).astype(np.uint64) // np.uint64(9))
    order, common = suffix_sort.suffix_sort(raw, begin, length, group, hashes)
    texts = [raw[b:b + n].tobytes() for b, n in zip(begin, length)]
    for g in range(7):
        rows = np.flatnonzero(group == g)
        place = order[rows]
        assert sorted(place.tolist()) == rows.tolist()
        assert [texts[i] for i in place] == sorted(texts[i] for i in rows)
        for k in range(1, len(rows)):
            x, y = texts[place[k - 1]], texts[place[k]]
            same = next((i for i, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))
            assert common[rows[k]] == same


def test_cosines_of_exactly_the_threshold_are_links(spark):
    """Integer vectors at exactly 0.9, in every scale and order, and the nearest ones below it."""
    rnd = random.Random(8)
    rows, links = [], {}
    for k in range(2000):
        # Orthogonal blocks of four places, so that different pairs have nothing in common.
        base, other = [1, 0, 0, 0], [9, 3, 3, 1]
        order = rnd.sample(range(4), 4)
        scale = rnd.choice([1, 3, 7, 10, 1000])
        place = lambda v: [float(v[i] * scale) for i in order]
        if k % 10 == 9:
            other = [9, 3, 3, 1.0000001]  # just below
        at = 4 * (k % 16)
        a, b = [0.0] * 64, [0.0] * 64
        a[at:at + 4], b[at:at + 4] = place(base), place(other)
        rows.append((a, b, k % 10 != 9))
    for a, b, want in rows:
        assert rp_forest.reaches(np.array(a), np.array(b), 0.9) == want
        x, y = (rp_forest.unit([np.array(v, "<f8").tobytes()]) for v in (a, b))
        assert rp_forest.near_pairs(x, y, np.array([a]), np.array([b]), 0.9)[0, 0] == want
    one = {tuple(v) for r in rows[:160:16] for v in r[:2]}
    vectors = [list(v) for v in sorted(one)]
    table = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    for i, a in enumerate(vectors):
        links[i] = sum(rp_forest.reaches(np.array(a), np.array(b), 0.9) for j, b in enumerate(vectors) if j != i)
    got = rp_forest.near_duplicates(table).collect()
    assert {r["vec_id"]: r["n_links"] for r in got} == links and any(links.values())
    # What is counted and what is joined agree: a vector without links is alone.
    sizes = {}
    for r in got:
        sizes[r["component_id"]] = sizes.get(r["component_id"], 0) + 1
    assert all((r["n_links"] > 0) == (sizes[r["component_id"]] > 1) for r in got)
