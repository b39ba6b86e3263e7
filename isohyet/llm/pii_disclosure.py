"""Personal data, and the terms that give it away.

Spans of fixed patterns are the protected entities. Corpus co-occurrence estimates
how strongly a term t reveals an entity e: with n_e and n_t documents that hold them,
n_et documents in which t stands near e, and N documents, the pointwise mutual
information log2(N n_et / (n_e n_t)) as a share of the entity's information log2(N / n_e)
is 1 where the term never occurs without the entity. A term is disclosing for an entity if that share
reaches a threshold, the information is worth some bits, and documents and different contexts enough
support it, so that copies of one text count once. Disclosing terms become spans wherever
they occur: beyond a second threshold they are removed, else generalised to a class of terms.

Three passes over the texts: contexts of entities, document counts of the candidate terms,
and the spans. A fixed bitmap of hashes (a few MB at any size) tells the passes which words may matter; what
passes it is joined with the exact terms. Pairs are formed in a window of words around an
entity, so they grow with the text; an entity in a third of all documents is combined before each shuffle.

Defined cases: null text is empty, with no spans; repeated rows give repeated results and are documents of
their own in the counts; a null id stays null; other columns are left out; an empty table gives no rows. Overlapping spans of different kinds all stay.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isohyet.llm.pii_spans import KINDS, base_spans, entity
from isohyet.llm.texts import id_and_text, map_texts, settled

# ASCII letters and digits, and all other characters; punctuation ends a term.
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
# Terms on each side of an entity that count as near it.
WINDOW = 10
# Documents, and different contexts, in which a term stands near an entity.
MIN_DOCS = MIN_CONTEXTS = 3
# Shares of an entity's information at which a term is generalised, and removed; bits that it must give away.
GENERALISE_AT, REMOVE_AT, MIN_BITS = 0.9, 0.95, 4.0
BITS = 1 << 25
REMEMBERED = 500_000

NEAR = "entity string, term string, context long, docs long"
FOUND = ("doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, base string, "
         "hits array<struct<term: string, start: long, end: long>>")


def normal(term: str) -> str:
    return term.lower() if term.isascii() else term.encode().lower().decode()


def _outside(text: str, spans: list[tuple[str, int, int]]) -> list[re.Match]:
    """Terms of a text that no base span touches."""
    terms = list(TERM.finditer(text))
    if not spans:
        return terms
    covered = np.zeros(len(text) + 1, np.int32)
    for _, low, high in spans:
        covered[low] += 1
        covered[high] -= 1
    inside = np.cumsum(np.cumsum(covered) > 0)
    before = np.concatenate([[0], inside])
    return [m for m in terms if before[m.end()] == before[m.start()]]


def contexts(text: str) -> list[tuple[str, str | None, int, int]]:
    """(entity, term, hash of the context, 1 for the first of an entity and term, else 0); an entity itself stands with term None."""
    spans = base_spans(text)
    if not spans:
        return []
    terms = _outside(text, spans)
    starts = [m.start() for m in terms]
    words = [normal(m.group()) for m in terms]
    seen, out = set(), []
    for kind, low, high in spans:
        who = entity(kind, text[low:high])
        at = int(np.searchsorted(starts, low))
        left, right = words[max(at - WINDOW, 0):at], words[at:at + WINDOW]
        context = zlib.crc32(" ".join(left[-3:] + ["@"] + right[:3]).encode())
        for term in (None, *dict.fromkeys(left + right)):
            if (who, term, context) not in seen:
                out.append((who, term, context, int((who, term) not in seen)))
                seen |= {(who, term, context), (who, term)}
    return out


def _near(docs: DataFrame) -> DataFrame:
    def start():
        def work(ids, texts):
            found = [x for t in texts for x in contexts(t)]
            return [list(c) for c in zip(*found)] or [[], [], [], []]

        return work

    return map_texts(docs, NEAR, start)


def _bitmap(terms: DataFrame) -> bytes:
    """Bits of the terms' hashes: at most BITS of them, combined by Spark in pieces."""
    place = F.pmod(F.crc32(F.col("term").cast("binary")), F.lit(BITS)) + 1  # Spark's buckets count from 1
    pieces = terms.select(F.bitmap_bucket_number(place).alias("bucket"), F.bitmap_bit_position(place).alias("bit")).groupBy("bucket").agg(
        F.bitmap_construct_agg("bit").alias("bits")).collect()
    bits = bytearray(BITS // 8)
    for piece in pieces:
        low = (piece["bucket"] - 1) * 4096
        bits[low:low + 4096] = piece["bits"]
    return bytes(bits)


class TermFilter:
    """Whether a term's hash is among those of a bitmap; answers are remembered."""

    def __init__(self, bits: bytes):
        self.bits, self.known = bits, {}

    def __call__(self, word: str) -> bool:
        hit = self.known.get(word)
        if hit is None:
            if len(self.known) > REMEMBERED:
                self.known.clear()
            place = zlib.crc32(normal(word).encode()) % BITS
            hit = self.known[word] = bool(self.bits[place >> 3] >> (place & 7) & 1)
        return hit


def _document_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """term, n_t: documents that hold each of the terms."""
    shared = docs.sparkSession.sparkContext.broadcast(_bitmap(terms))

    def start():
        passes = TermFilter(shared.value)

        def work(ids, texts):
            n = Counter()
            for text in texts:
                n.update({normal(w) for w in set(TERM.findall(text)) if passes(w)})
            return [list(n), list(n.values())]

        return work

    counts = map_texts(docs, "term string, n long", start).groupBy("term").agg(F.sum("n").alias("n_t"))
    return counts.join(terms, "term")


def disclosing_terms(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS, min_contexts: int = MIN_CONTEXTS,
                     generalise_at: float = GENERALISE_AT, remove_at: float = REMOVE_AT, min_bits: float = MIN_BITS) -> DataFrame:
    """term, entity, n_docs (N), n_e, n_t, n_et, bits, share, action (remove, generalise): what each term reveals."""
    docs = id_and_text(docs, id_col, text_col)
    n_docs = docs.count()
    # Counted by context first, so that an entity of very many documents is spread and combined.
    near = settled(_near(docs).groupBy("entity", "term", "context").agg(F.sum("docs").alias("docs")).groupBy("entity", "term").agg(
        F.sum("docs").alias("docs"), F.count("*").alias("contexts")).filter(F.col("term").isNull() | (
            (F.col("docs") >= min_docs) & (F.col("contexts") >= min_contexts))))
    pairs = near.filter("term is not null").select("entity", "term", F.col("docs").alias("n_et"))
    entities = near.filter("term is null").select("entity", F.col("docs").alias("n_e"))
    worth = pairs.join(entities, "entity").withColumn("_whole", F.log2(F.lit(float(n_docs)) / F.col("n_e"))).filter(F.col("_whole") >= min_bits)
    worth = settled(worth)
    terms = worth.select("term").distinct()
    scored = worth.join(_document_counts(docs, terms), "term").withColumn(
        "bits", F.log2(F.lit(float(n_docs)) * F.col("n_et") / (F.col("n_e") * F.col("n_t").cast("double")))).withColumn("share", F.col("bits") / F.col("_whole"))
    return scored.filter((F.col("share") >= generalise_at) & (F.col("bits") >= min_bits)).select(
        "term", "entity", F.lit(n_docs).cast("long").alias("n_docs"), "n_e", "n_t", "n_et", "bits", "share",
        F.when(F.col("share") >= remove_at, "remove").otherwise("generalise").alias("action"))


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _found(docs: DataFrame, terms: DataFrame) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(_bitmap(terms))

    def start():
        passes = TermFilter(shared.value)
        any_bits = any(shared.value)

        def row(doc, text):
            spans = base_spans(text)
            counts = Counter(k for k, _, _ in spans)
            base = _joined(spans)
            hits = []
            if any_bits and any(map(passes, set(TERM.findall(text)))):
                hits = [(normal(m.group()), m.start(), m.end()) for m in _outside(text, spans) if passes(m.group())]
            return (doc, *(counts[k] for k in KINDS), hashlib.sha256(base.encode()).hexdigest(), base,
                    [{"term": t, "start": a, "end": b} for t, a, b in hits])

        return lambda ids, texts: list(zip(*map(row, ids, texts)))

    return map_texts(docs, FOUND, start)


def find(docs: DataFrame, terms: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_terms for every row.

    `terms` are disclosing terms (term, action), by default those of `docs` itself. Their spans
    have the kind `term` and stand behind those of the patterns.
    """
    if terms is None:
        terms = disclosing_terms(docs, id_col, text_col)
    # Of several entities the one that a term reveals most decides.
    actions = settled(terms.groupBy("term").agg(F.max("action").alias("action")))
    rows = settled(_found(id_and_text(docs, id_col, text_col), actions.select("term")).withColumn("_key", F.monotonically_increasing_id()))
    return _with_terms(rows, actions)


def _with_terms(rows: DataFrame, actions: DataFrame) -> DataFrame:
    hit = rows.filter(F.size("hits") > 0)
    true = hit.select("_key", F.explode("hits").alias("h")).select("_key", "h.*").join(actions, "term").groupBy("_key").agg(
        F.sort_array(F.collect_list(F.struct("start", "end"))).alias("terms"))
    plain = rows.filter(F.size("hits") == 0).withColumn("terms", F.lit(None).cast("array<struct<start: long, end: long>>"))
    both = hit.join(true, "_key", "left").unionByName(plain)
    said = F.transform("terms", lambda x: F.concat_ws(":", F.lit("term"), x["start"], x["end"]))
    return both.select(
        "doc_id", *[f"n_{k}" for k in KINDS], "base_sha256",
        F.concat_ws(",", F.when(F.col("base") != "", F.array("base")), said).alias("spans"), F.coalesce(F.size("terms"), F.lit(0)).cast("long").alias("n_terms"))


def generalised(term: str) -> str:
    """The class of terms that stands for a term."""
    if any(c.isdigit() for c in term):
        return "[NUMBER]"
    return "[NAME]" if term[0].isupper() else "[TERM]"


def sanitised_text(text: str, spans: list[tuple[str, int, int]], actions: dict[str, str]) -> str:
    """Patterns become their kinds; terms are removed or generalised. Of overlapping spans the first, then the longest counts."""
    out, end = [], 0
    for kind, low, high in sorted(spans, key=lambda s: (s[1], -s[2])):
        if low < end:
            end = max(end, high)
            continue
        new = f"[{kind.upper()}]"
        if kind == "term":
            new = "" if actions[normal(text[low:high])] == "remove" else generalised(text[low:high])
        out += [text[end:low], new]
        end = high
    return "".join(out) + text[end:]


def sanitised(docs: DataFrame, terms: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text with the personal data replaced, for every row."""
    if terms is None:
        terms = disclosing_terms(docs, id_col, text_col)
    actions = settled(terms.groupBy("term").agg(F.max("action").alias("action")))
    source = id_and_text(docs, id_col, text_col)
    rows = settled(source.withColumn("_key", F.monotonically_increasing_id()))
    keyed = rows.select(F.col("_key").alias("doc_id"), "text")
    hits = _found(keyed, actions.select("term")).select(F.col("doc_id").alias("_key"), F.explode("hits").alias("h")).select("_key", "h.term").distinct()
    known = hits.join(actions, "term").groupBy("_key").agg(F.map_from_entries(F.collect_list(F.struct("term", "action"))).alias("actions"))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            out = []
            for text, actions in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                chosen = dict(actions or {})
                spans = base_spans(text)
                if chosen:
                    spans += [("term", m.start(), m.end()) for m in _outside(text, spans) if normal(m.group()) in chosen]
                out.append(sanitised_text(text, spans, chosen))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=["doc_id", "text"])

    return rows.join(known, "_key", "left").select("doc_id", "text", "actions").mapInArrow(run, "doc_id long, text string")
