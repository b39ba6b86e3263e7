"""Quality rules with risk-controlled cutoffs.

Each rule rejects a document whose measure lies above a cutoff. Cutoffs are
chosen per stratum from labelled documents, so that with confidence 1 - delta,
over all strata and rules together, a good document is rejected with a
probability of at most alpha:

* a rule may take alpha / (number of rules) of a stratum's good documents;
* a cutoff is certified when the exact binomial probability of as few false
  rejections as were seen, at that risk, is at most delta / (strata * rules);
* the cutoffs of a rule form a fixed list, tested from the mildest on until one
  fails (fixed-sequence testing, which needs no further correction).

Among the certified cutoffs a rule takes the one that parts bad from good best.
A stratum with too few labels certifies nothing and rejects nothing.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isohyet.llm.texts import CHUNK_CHARS, settled, words_of

WINDOW = 5
SYMBOLS = "#*$%&|<>"
_CAPITALS = re.compile("[A-ZÀ-ÖØ-Þ]")
ALPHA, DELTA = 0.05, 0.1
# Strata whose cutoffs are handed out to all tasks; more are joined by a shuffle.
BROADCAST_STRATA = 100_000
# Weight of a good document's rejection against a bad one's when certified cutoffs are compared.
GOOD_WEIGHT = 10.0

# Measures of the rules and their cutoffs, mildest first. All measures grow with badness.
RULES: dict[str, tuple[float, ...]] = {
    "symbols_a_word": (2.0, 1.5, 1.0, 0.8, 0.6, 0.4, 0.3, 0.2, 0.15, 0.1, 0.05),
    "repeated_share": (0.2, 0.19, 0.18, 0.16, 0.14, 0.12, 0.1, 0.08, 0.06, 0.04),
    "repeated_line_share": (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1),
    "doubled_share": (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1, 0.05),
    "capitals_share": (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2),
    "word_length": (40.0, 30.0, 20.0, 16.0, 14.0, 12.0, 10.0),
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_doubled", "n_capitals")


def repeat_words(ids: np.ndarray, doc: np.ndarray, n_docs: int, window: int = WINDOW) -> np.ndarray:
    """Per document, the words inside windows that occur twice or more in it.

    Windows get exact numbers: a window of k + 1 words of a document is numbered
    by the number of its first k words and its last word.
    """
    n = len(ids)
    if n < window:
        return np.zeros(n_docs, np.int64)
    # Only where all word pairs of a window occur twice in the document can the window do so.
    pair = (ids[:-1].astype(np.int64) * n_docs + doc[:-1]) * (n + 1) + ids[1:]
    _, number, count = np.unique(pair, return_inverse=True, return_counts=True)
    again = (count[number] > 1) & (doc[1:] == doc[:-1])
    run = np.ones(n - window + 1, bool)
    for k in range(window - 1):
        run &= again[k:n - window + 1 + k]
    starts = np.flatnonzero(run)
    number = doc[starts].astype(np.int64)
    for k in range(window):
        number = np.unique(number * (n + 1) + ids[starts + k], return_inverse=True)[1].astype(np.int64)
    starts = starts[np.bincount(number)[number] > 1] if len(starts) else starts
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + window, -1)
    return np.bincount(doc[np.cumsum(change[:n]) > 0], minlength=n_docs)


def counts_of(texts: list[str]) -> list[list[int]]:
    """One list per name in COUNTS."""
    words = [words_of(t) for t in texts]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    numbers: dict[str, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for ws in words for w in ws), np.int64, int(sizes.sum()))
    doc = np.repeat(np.arange(len(texts)), sizes)
    repeats = repeat_words(ids, doc, len(texts))
    same = (ids[1:] == ids[:-1]) & (doc[1:] == doc[:-1])
    doubled = np.bincount(doc[1:][same], minlength=len(texts))
    lines, dup_lines = [], []
    for t in texts:
        own = [x for x in t.split("\n") if words_of(x)] if "\n" in t else ([t] if words_of(t) else [])
        lines.append(len(own))
        dup_lines.append(len(own) - len(set(own)))
    return [sizes.tolist(), [sum(map(len, ws)) for ws in words], [sum(map(t.count, SYMBOLS)) for t in texts], dup_lines,
            repeats.tolist(), lines, doubled.tolist(), [len(_CAPITALS.findall(t)) for t in texts]]


def counted() -> Callable[[Column], Column]:
    """A column function: text -> struct of COUNTS. Only the text goes through Arrow, other columns stay where they are."""
    @F.pandas_udf(", ".join(f"{c} long" for c in COUNTS))
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in texts:
            done, chunk, size = [], [], 0
            for t in part:
                if size > CHUNK_CHARS:
                    done.append(pd.DataFrame(dict(zip(COUNTS, counts_of(chunk)))))
                    chunk, size = [], 0
                chunk.append(t)
                size += len(t)
            done.append(pd.DataFrame(dict(zip(COUNTS, counts_of(chunk)))))
            yield pd.concat(done, ignore_index=True)

    return run


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", strata: tuple[str, ...] = (),
            keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, `_row` (a struct of the columns to keep), `_stratum` (a text of the strata columns), the counts and base_failed."""
    stratum = F.to_json(F.array(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in strata])) if strata else F.lit("[]")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), *[F.struct(*keep).alias("_row")] * bool(keep),
                       stratum.alias("_stratum"), counted()(F.coalesce(F.col(text_col), F.lit(""))).alias("_counts"))
    return rows.select(*[c for c in rows.columns if c != "_counts"], "_counts.*").withColumn(
        "base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))


def measures() -> dict[str, Column]:
    words = F.greatest(F.col("n_words"), F.lit(1))
    chars = F.greatest(F.col("word_chars"), F.lit(1))
    return {
        "symbols_a_word": F.col("n_symbols") / words, "repeated_share": F.col("n_repeat_words") / words,
        "repeated_line_share": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "doubled_share": F.col("n_doubled") / words, "capitals_share": F.col("n_capitals") / chars,
        "word_length": F.col("word_chars") / words,
    }


def at_most(k: int, n: int, p: float) -> float:
    """P(X <= k) for X binomial (n, p), exactly summed from the largest term down."""
    if k >= n:
        return 1.0
    log_p, log_q = math.log(p), math.log1p(-p)
    terms = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * log_p + (n - i) * log_q
             for i in range(k + 1)]
    return math.fsum(map(math.exp, terms))


def choose_cutoff(good: int, bad: int, good_above: list[int], bad_above: list[int], cutoffs: tuple[float, ...],
                  risk: float, level: float) -> float | None:
    """The certified cutoff that parts bad from good best, the milder one on ties; None without any gain."""
    best, best_gain = None, 0.0
    for cutoff, g, b in zip(cutoffs, good_above, bad_above):
        # More false rejections than the risk allows on average can never be certified.
        if not good or g > risk * good or at_most(g, good, risk) > level:
            break
        gain = (b / bad if bad else 0.0) - GOOD_WEIGHT * g / good
        if gain > best_gain:
            best, best_gain = cutoff, gain
    return best


def calibrate(measured: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA,
              label_col: str = "quality") -> DataFrame:
    """_stratum and one column per rule with its cutoff, null where nothing is certified.

    Labels count for documents that pass the base rules. A document labelled
    more than once counts with its lowest label.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    known = known.filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("label").alias("label"))
    held = measured.filter(~F.col("base_failed")).join(known, "doc_id")
    good, bad = F.col("label") == 1, F.col("label") == 0
    tallies = [F.count_if(good).alias("good"), F.count_if(bad).alias("bad")]
    for rule, value in measures().items():
        for i, cutoff in enumerate(RULES[rule]):
            tallies += [F.count_if(good & (value > cutoff)).alias(f"good_{rule}_{i}"),
                        F.count_if(bad & (value > cutoff)).alias(f"bad_{rule}_{i}")]
    by_stratum = settled(held.groupBy("_stratum").agg(*tallies))
    tests = max(1, by_stratum.count()) * len(RULES)
    risk, level = alpha / len(RULES), delta / tests

    def choose(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = {"_stratum": frame["_stratum"]}
            for rule, cutoffs in RULES.items():
                out[rule] = [choose_cutoff(
                    int(r["good"]), int(r["bad"]), [int(r[f"good_{rule}_{i}"]) for i in range(len(cutoffs))],
                    [int(r[f"bad_{rule}_{i}"]) for i in range(len(cutoffs))], cutoffs, risk, level,
                ) for _, r in frame.iterrows()]
            yield pd.DataFrame(out).astype({rule: "float64" for rule in RULES})

    return by_stratum.mapInPandas(choose, "_stratum string, " + ", ".join(f"{r} double" for r in RULES))


def judge(measured: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """A stored table of measure() with failed_rules and kept."""
    cutoffs = settled(calibrate(measured, labels, alpha, delta))
    # A row per stratum. Handed out if few, so that a stratum with most of the rows needs no shuffle.
    few = cutoffs.count() <= BROADCAST_STRATA
    joined = measured.join(F.broadcast(cutoffs) if few else cutoffs, "_stratum", "left")
    # pandas hands an absent cutoff over as NaN.
    failed = {rule: F.coalesce((value > F.col(rule)) & ~F.isnan(rule), F.lit(False)) for rule, value in measures().items()}
    rejected = F.filter(F.array(*[F.when(f, F.lit(rule)) for rule, f in failed.items()]), lambda x: x.isNotNull())
    return joined.select(*measured.columns, rejected.alias("failed_rules")).withColumn(
        "kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))


def apply_rules(docs: DataFrame, labels: DataFrame, strata: tuple[str, ...] = ("lang",), alpha: float = ALPHA,
                delta: float = DELTA, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the counts, base_failed, kept and the rules that reject, for every row.

    A null or empty text has no words and fails the base rules. A null stratum
    value counts as the empty one. Repeated rows give repeated results, a null id
    stays null, other columns are left out. Without labels only the base rules reject.
    """
    judged = judge(settled(measure(docs, id_col, text_col, strata)), labels, alpha, delta)
    return judged.select("doc_id", *COUNTS, "base_failed", "failed_rules", "kept")


def kept_rows(docs: DataFrame, labels: DataFrame, strata: tuple[str, ...] = ("lang",), alpha: float = ALPHA,
              delta: float = DELTA) -> DataFrame:
    """The rows of `docs` that no rule rejects. Texts are not shuffled."""
    judged = judge(settled(measure(docs, strata=strata, keep=tuple(docs.columns))), labels, alpha, delta)
    return judged.filter("kept").select("_row.*")
