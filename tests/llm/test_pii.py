"""Personal data against the contract's regular expressions, and disclosing terms against plain counting."""

import hashlib
import math
import random
import re
import time
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from isohyet.llm import pii_disclosure as pii
from isohyet.llm import pii_spans, queries
from tests.llm.common import SF, frame, needs_tables

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    return sum(n if i % 2 == 0 else n * 2 - 9 * (n > 4) for i, n in enumerate(map(int, reversed(digits)))) % 10 == 0


def plain_spans(text):
    text = text or ""
    count = lambda m: re.sub(r"\D", "", m.group(), flags=re.A)
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 16 <= len(count(m)) <= 19 and luhn(count(m))]
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(count(m)) <= 15]


def base_row(doc, text):
    spans = plain_spans(text)
    n = Counter(k for k, _, _ in spans)
    joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
    return (doc, n["email"], n["ip"], n["card"], n["phone"], hashlib.sha256(joined.encode()).hexdigest()), joined


ODD = ["a@b.c@d.e.f", "x@@y.z", "@a.b", "a@b", "a@b.", "a.b@c-d.e..f@g.h", "1.2.3.4.5.6.7.8", "1.2.3.256 1.2.3.4", "0001.2.3.4", "4111 1111 1111 1111", "4111-1111-1111-11113",
       "4111  1111 1111 1111", "+1 (017) 555-7713.", "+1", "++49 30 1234567", "+49(30)1234567890123", "+1 2 3 4 5 6 7 8 )", "é@b.co日@x.y", "\x00+0 00000000"]


def test_patterns():
    rnd = random.Random(3)
    texts = ODD + ["".join(rnd.choice("1234.@+- ()aé-%") for _ in range(rnd.randrange(120))) for _ in range(2000)]
    texts += ["".join(rnd.choice(["4111111111111111", "5500 0000 0000 0004", "1.2.3.4", "a@b.cd", "+1 234 567 8900", " ", ".", "-", "7"]) for _ in range(12)) for _ in range(500)]
    for text in texts:
        assert pii_spans.base_spans(text) == plain_spans(text), text


def test_patterns_take_linear_time():
    began = time.time()
    for unit in ("a", "a.", "1", "1.", "1 ", "+1", "@a", "a@", "a@b", "-", "+1 ("):
        pii_spans.base_spans(unit * 300_000)
    assert time.time() - began < 20


def plain_terms(texts):
    """term -> action by counting every document for every entity and term."""
    n_e, n_t, n_et, around = Counter(), Counter(), Counter(), defaultdict(set)
    for text in texts:
        spans = plain_spans(text)
        words = [m for m in pii.TERM.finditer(text or "")]
        n_t.update({pii.normal(m.group()) for m in words})
        free = [m for m in words if not any(m.start() < b and m.end() > a for _, a, b in spans)]
        here = set()
        for kind, a, b in spans:
            who = pii_spans.entity(kind, text[a:b])
            left = [pii.normal(m.group()) for m in free if m.start() < a][-10:]
            right = [pii.normal(m.group()) for m in free if m.start() >= a][:10]
            here |= {(who, t) for t in left + right} | {(who, None)}
            for t in left + right:
                around[who, t].add((tuple(left[-3:]), tuple(right[:3])))
        n_et.update(x for x in here if x[1] is not None)
        n_e.update(w for w, t in here if t is None)
    out = {}
    for (who, t), n in n_et.items():
        whole = math.log2(len(texts) / n_e[who])
        if n < 3 or len(around[who, t]) < 3 or whole < pii.MIN_BITS:
            continue
        bits = math.log2(len(texts) * n / (n_e[who] * n_t[t]))
        if bits >= pii.MIN_BITS and bits / whole >= pii.GENERALISE_AT:
            out[t] = max(out.get(t, ""), "remove" if bits / whole >= pii.REMOVE_AT else "generalise")
    return out


def corpus(seed=1, n=400):
    rnd = random.Random(seed)
    word = lambda: f"w{chr(97 + rnd.randrange(26))}{chr(97 + rnd.randrange(20))}"
    texts = []
    for i in range(n):
        words = [word() for _ in range(30)]
        if i % 40 == 0:  # One address always beside one name, in changing sentences.
            words[10:10] = ["Zoltan", word(), f"Zoltan.K{i % 3 * 0}@example.com"]
        if i % 50 == 7:
            words[5:5] = ["badge", "QX77", word(), "10.1.2.3"]
        if i % 3 == 0:  # An address in a third of all documents reveals nothing about anyone.
            words[20:20] = ["write", "to", "info@example.org"]
        if i % 80 == 9:
            words += ["badge"]
        texts.append(" ".join(words))
    # Copies of one text don't make its words telling.
    texts += ["singular hapax words around copy@example.com only here"] * 20
    return texts


def answers(df):
    return {(r["doc_id"], r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"], r["spans"]) for r in df.collect()}


def plain_find(rows):
    terms = plain_terms([t for _, t in rows])
    out = set()
    for doc, text in rows:
        row, joined = base_row(doc, text)
        spans = plain_spans(text)
        more = [f"term:{m.start()}:{m.end()}" for m in pii.TERM.finditer(text or "")
                if pii.normal(m.group()) in terms and not any(m.start() < b and m.end() > a for _, a, b in spans)]
        out.add((*row, ",".join([joined] * bool(joined) + more)))
    return out


def test_disclosing_terms(spark):
    texts = corpus()
    rows = list(enumerate(texts))
    docs = frame(spark, rows)
    got = {}
    for r in pii.disclosing_terms(docs).collect():
        got[r["term"]] = max(got.get(r["term"], ""), r["action"])
    assert got == plain_terms(texts)
    assert {"zoltan", "qx77"} <= {*got} and not {"write", "info", "hapax", "badge"} & {*got} - {"badge"}
    assert answers(pii.find(docs)) == plain_find(rows)


def test_sanitised_texts(spark):
    texts = corpus()
    out = {r["doc_id"]: r["text"] for r in pii.sanitised(frame(spark, list(enumerate(texts)))).collect()}
    assert len(out) == len(texts)
    joined = "\n".join(out.values())
    assert "@" not in joined and "Zoltan" not in joined and "[EMAIL]" in joined and "QX77" not in joined
    assert out[1] == texts[1]
    assert pii.sanitised_text("Ann 12 a@b.cd Ann", [("term", 0, 3), ("term", 4, 6), ("email", 7, 13)], {"ann": "generalise", "12": "remove"}) == "[NAME]  [EMAIL] Ann"


def test_odd_rows(spark):
    rows = [(1, "a@b.cd"), (1, "a@b.cd"), (2, None), (3, ""), (None, "1.2.3.4"), (4, "word " * 60_000 + "x@y.zz"), (5, "日本 " * 300)] + [
        (10 + i, t) for i, t in enumerate(ODD)]
    clash = frame(spark, rows).withColumns({n: F.lit("x") for n in ("term", "entity", "hits", "spans", "base", "_key", "n_t", "action", "kind", "bits")})
    result = pii.find(clash).collect()
    assert len(result) == len(rows)
    assert {(*base_row(d, t)[0], base_row(d, t)[1]) for d, t in rows} == answers(pii.find(clash))
    empty = frame(spark, [])
    assert pii.find(empty).collect() == [] and pii.sanitised(empty).collect() == [] and pii.disclosing_terms(empty).collect() == []


def test_term_filter_has_no_false_negatives(spark):
    terms = spark.range(5000).select(F.concat(F.lit("term日"), "id").alias("term"))
    passes = pii.TermFilter(pii._bitmap(terms))
    assert all(passes(f"TERM日{i}") for i in range(5000))
    assert sum(passes(f"other{i}") for i in range(5000)) < 50


@needs_tables
def test_query_on_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert answers(queries.QUERIES["op11_pii"](spark, SF)) == plain_find(rows)
