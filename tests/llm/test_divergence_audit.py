"""Source divergence against counting every term of every pair."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from isohyet.llm import divergence_audit as divergence
from isohyet.llm import queries
from tests.llm.common import LOWER, SF, needs_tables

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SCALE = 10**9


def plain_audit(rows, top=200):
    """The contract term by term; rows of (text, lang, source)."""
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        terms = TERM.findall((text or "").translate(LOWER))
        counts[lang or "", source or ""].update(terms)
        docs[lang or ""].update({*terms})
        groups.add((lang or "", source or ""))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= 3]
        sources = [s for g, s in groups if g == lang]

        def shares(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + SCALE * (count[t] + 1) // (total + len(kept)) for t in kept}

        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in sources if o != s]
            terms = [((p[s][t] - q[t]) ** 2 // q[t], t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found, limit in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(found[:limit])]
    return sorted(out)


def answers(df):
    return sorted(tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in df.collect())


def make(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, lang string, source string")


def corpus(seed, n, words, sources):
    rnd = random.Random(seed)
    return [(" ".join(f"W{chr(97 + rnd.randrange(words) % 26)}{'é' * (rnd.randrange(words) // 26)}" for _ in range(rnd.randrange(30))),
             rnd.choice(["en", "de", None]), f"s{rnd.randrange(sources)}" if rnd.random() < 0.6 else "s0") for _ in range(n)]


def test_equals_counting_every_term(spark, monkeypatch):
    monkeypatch.setattr(divergence, "HELD", 50)
    monkeypatch.setattr(divergence, "BLOCK_TERMS", 7)
    rows = corpus(1, 300, 200, 5) + [("the " * 5000, "en", "s1")] * 40
    rows += [(None, "en", "empty"), ("", None, None), ("1 2 3 __ [x]", "fr", "a"), ("rare Été", "fr", "b"), ("日本 日本", "ja", "x")] * 2
    assert answers(divergence.audit(make(spark, rows))) == plain_audit(rows)
    assert answers(divergence.audit(make(spark, rows), top=3)) == plain_audit(rows, 3)


def test_terms():
    text = "Don't STOP-now_x[Y]é\x00日本\x7fÀB 12\tİ"
    assert [t.decode() for t in divergence.terms_of(text.encode())] == TERM.findall(text.translate(LOWER))


def test_runs_against_dense_columns():
    rnd = np.random.default_rng(3)
    for _ in range(30):
        rows = int(rnd.integers(1, 40))
        begins = np.concatenate([[0], np.cumsum(rnd.integers(1, 5, rows))])
        dense = [np.where(rnd.random(rows) < 0.6, 0, rnd.integers(1, 3, rows)) for _ in range(2)]
        totals = [int(d @ np.diff(begins)) + int(begins[-1]) for d in dense]
        runs = [divergence.Runs(np.flatnonzero(d), d[d > 0], begins, n) for d, n in zip(dense, totals)]
        p, q = [np.repeat([1 + SCALE * (int(c) + 1) // n for c in d], np.diff(begins)) for d, n in zip(dense, totals)]
        assert divergence.pair_values(*runs, int(begins[-1])) == (sum((p - q) ** 2 // q), sum((p - q) ** 2 // p))
        assert all(len(r.starts) <= 1 + int((np.diff(d) != 0).sum()) for r, d in zip(runs, dense))


def test_large_counts_are_exact():
    """Counts beyond 9e9, whose products leave 64 bits, and sums of f times length near the largest long."""
    begins = np.array([0, 1, 10**9])
    a = divergence.Runs(np.array([0]), np.array([10**12]), begins, 10**12 + 10**9)
    assert a.p.tolist() == [1 + SCALE * (10**12 + 1) // (10**12 + 10**9), 1]
    f = np.array([2**59 - 1, 12345678901])
    assert divergence._weighted(f, np.array([10, 10**8])) == int(f[0]) * 10 + int(f[1]) * 10**8


def test_empty_table_and_clashing_columns(spark):
    assert answers(divergence.audit(make(spark, []))) == []
    rows = corpus(2, 60, 20, 3)
    clash = make(spark, rows).withColumns({n: F.lit("x") for n in ("term", "n", "docs", "counts", "block", "kind", "rank", "part", "item", "value", "p", "q")})
    assert answers(divergence.audit(clash)) == plain_audit(rows)


@needs_tables
def test_query_on_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("text", "lang", "source").collect()]
    assert answers(queries.QUERIES["op13_source_divergence"](spark, SF)) == plain_audit(rows)
