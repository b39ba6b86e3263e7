"""Quality classifier with supervised subword embeddings.

A document is the average of learned vectors of its words, of their character
n-grams and of its word pairs, hashed into a fixed number of rows; a softmax
layer over the average gives the label. Word pairs share three rows, as single
pairs are too rare to learn from: a pair seen before in the text, a word that
follows itself, and a row for the text itself, which keeps short texts near the
average. Vectors and layer are trained together by stochastic gradient descent
in numpy, in one task, on a bounded sample of labelled rows.

The layer is linear in the average, so each hashed row comes down to one number
for scoring. Tasks remember those sums per word and score whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq, mul

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isohyet.llm.texts import id_and_text, map_texts, words_of

ROWS_BITS = 17
DIM = 16
NGRAMS = (3, 4, 5)
EPOCHS, LEAST_STEPS = 8, 12_000  # small samples are gone through more often
RATE = 0.5
# Labelled rows of each class that training takes at most.
ROWS_PER_CLASS = 1_500
REMEMBERED = 800_000
# Rows after the hashed ones: the text itself (as often as given), repeated pairs, words that follow themselves.
TEXT_ROWS, EXTRA = 40, 3
_BASE = np.uint64(0x9E3779B97F4A7C15)


class Features:
    """Hashed rows of words: the word itself and the character n-grams of <word>."""

    def __init__(self, bits: int = ROWS_BITS, ngrams: tuple[int, ...] = NGRAMS):
        self.shift, self.ngrams = np.uint64(64 - bits), ngrams

    def _rows(self, hashed: np.ndarray, kind: int) -> np.ndarray:
        x = hashed + np.uint64(kind) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
        return ((x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB) >> self.shift).astype(np.int64)

    def of_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Rows of all words, one after the other by word, and their number per word."""
        marked = [f"<{w}>" for w in words]
        lengths = np.fromiter(map(len, marked), np.int64, len(marked))
        codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        owner = np.repeat(np.arange(len(words)), lengths)
        start = np.cumsum(lengths) - lengths
        place = np.arange(len(codes)) - start[owner]
        with np.errstate(over="ignore"):
            power = np.cumprod(np.full(int(lengths.max(initial=1)), _BASE, np.uint64))
            whole = np.add.reduceat(codes * power[place], start) if len(words) else np.empty(0, np.uint64)
            rows, owners = [self._rows(whole, 0)], [np.arange(len(words))]
            for n in self.ngrams:
                if len(codes) < n:
                    continue
                hashed = np.zeros(len(codes) - n + 1, np.uint64)
                for k in range(n):
                    hashed = hashed * _BASE + codes[k:len(codes) - n + 1 + k]
                inside = place[:len(hashed)] + n <= lengths[owner[:len(hashed)]]
                rows.append(self._rows(hashed[inside], n))
                owners.append(owner[:len(hashed)][inside])
        owner = np.concatenate(owners)
        order = np.argsort(owner, kind="stable")
        return np.concatenate(rows)[order], np.bincount(owner, minlength=len(words))


def extra_counts(words: list[str]) -> tuple[int, int, int]:
    """How often each of the extra rows occurs in a text."""
    pairs = max(0, len(words) - 1)
    return TEXT_ROWS, pairs - len(set(zip(words, words[1:]))), sum(map(eq, words, words[1:]))


def train(texts: list[str], labels: list[int], bits: int = ROWS_BITS, dim: int = DIM, epochs: int = EPOCHS,
          rate: float = RATE, seed: int = 1) -> tuple[np.ndarray, float]:
    """Weight of each hashed row and the bias, for the log odds of label 1 in an evenly mixed sample."""
    features = Features(bits)
    docs = []
    for text in texts:
        words = words_of(text)
        index, count = np.unique(features.of_words(words)[0], return_counts=True)
        index, count = np.r_[index, (1 << bits) + np.arange(EXTRA)], np.r_[count, extra_counts(words)]
        docs.append((index, (count / count.sum()).astype(np.float32)))
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / dim, 1 / dim, ((1 << bits) + EXTRA, dim)).astype(np.float32)
    layer, bias = np.zeros((2, dim), np.float32), np.zeros(2, np.float32)
    n1 = max(1, sum(labels))
    n0 = max(1, len(labels) - n1)
    weight = np.array([0.5 * len(labels) / n0, 0.5 * len(labels) / n1], np.float32)
    epochs = max(epochs, -(-LEAST_STEPS // max(1, len(docs))))
    steps, step = epochs * len(docs), 0
    for _ in range(epochs):
        for i in rng.permutation(len(docs)).tolist():
            index, share = docs[i]
            rows = vectors[index]
            mean = share @ rows
            z = layer @ mean + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[labels[i]] -= 1
            step_rate = rate * (1 - step / steps) * min(5.0, float(weight[labels[i]]))
            back = layer.T @ p
            layer -= step_rate * np.outer(p, mean)
            bias -= step_rate * p
            vectors[index] = rows - step_rate * share[:, None] * back[None, :]
            step += 1
    direction = layer[1] - layer[0]
    return (vectors @ direction).astype(np.float64), float(bias[1] - bias[0])


class Scorer:
    def __init__(self, weights: np.ndarray, bias: float, bits: int = ROWS_BITS):
        self.weights, self.bias, self.features = weights, bias, Features(bits)
        self.extra = weights[1 << bits:].tolist()
        self.seen: dict[str, complex] = {}

    def scores(self, texts: list[str]) -> list[float]:
        cut = [words_of(t) for t in texts]
        new = set().union(*cut).difference(self.seen)
        if new:
            if len(self.seen) > REMEMBERED:
                self.seen.clear()
                new = set().union(*cut)
            new = list(new)
            rows, sizes = self.features.of_words(new)
            owner = np.repeat(np.arange(len(new)), sizes)
            total = np.bincount(owner, weights=self.weights[rows], minlength=len(new))
            # Sum of weights and number of rows of a word, as the two parts of one number.
            self.seen.update(zip(new, (total + 1j * sizes).tolist()))
        out = []
        for words in cut:
            both = sum(map(self.seen.__getitem__, words), 0j)
            extra = extra_counts(words)
            total = both.real + sum(map(mul, extra, self.extra))
            z = self.bias + total / (both.imag + sum(extra))
            out.append(1 / (1 + np.exp(-min(max(z, -500.0), 500.0))).item())
        return out


def held_out(doc_id: Column, folds: int = 3, fold: int = 1) -> Column:
    """Whether a document is kept from training: crc32 of its id as text; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, rows_per_class: int = ROWS_PER_CLASS, label_col: str = "quality",
        id_col: str = "doc_id", text_col: str = "text") -> tuple[np.ndarray, float]:
    """Train on at most `rows_per_class` labelled rows of each class that are not held out.

    The rows are chosen by a hash of their ids. A document labelled more than
    once counts with its lowest label, one with several texts with the smallest of them; null labels and labels other than 0 and
    1 are left out. The bias is set back to the share of the classes among all training labels.
    """
    usable = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label")).filter(
        F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    usable = usable.groupBy("doc_id").agg(F.min("label").alias("label"))
    sample = None
    for label in (0, 1):
        part = usable.filter(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows_per_class)
        sample = part if sample is None else sample.union(part)
    n = {r["label"]: r["count"] for r in usable.groupBy("label").count().collect()}
    prior = float(np.log((n.get(1, 0) + 1) / (n.get(0, 0) + 1)))
    # At most 2 * rows_per_class short rows.
    texts = id_and_text(docs, id_col, text_col).join(F.broadcast(sample), "doc_id").groupBy("doc_id").agg(
        F.min("text").alias("text"), F.first("label").alias("label"))

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("doc_id")
        weights, bias = train(group.column("text").to_pylist(), group.column("label").to_pylist())
        return pa.table({"weights": pa.array([weights.astype("<f8").tobytes()], pa.binary()), "bias": [bias]})

    model = texts.groupBy(F.lit(1).alias("all")).applyInArrow(run, "weights binary, bias double").collect()
    if not model or not n.get(0) or not n.get(1):
        return np.zeros((1 << ROWS_BITS) + EXTRA), prior if n else 0.0
    return np.frombuffer(model[0]["weights"], "<f8"), model[0]["bias"] + prior


def score(docs: DataFrame, model: tuple[np.ndarray, float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted for every row.

    An empty or null text scores by the bias alone. Repeated rows give repeated
    results, a null id stays null and is not held out, other columns are left out.
    """
    weights, bias = model
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # 8 bytes for each of 2^17 rows

    def start():
        scorer = Scorer(shared.value, bias)

        def work(ids, texts):
            return [ids, scorer.scores(texts)]

        return work

    scored = map_texts(id_and_text(docs, id_col, text_col), "doc_id long, score double", start)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def kept_rows(docs: DataFrame, model: tuple[np.ndarray, float], text_col: str = "text") -> DataFrame:
    """The rows of `docs` whose score is at least 0.5. Texts are not shuffled."""
    weights, bias = model
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    @F.pandas_udf("double")
    def score_of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(shared.value, bias)
        for part in texts:
            yield pd.Series([s for low in range(0, len(part), 500) for s in scorer.scores(part.iloc[low:low + 500].tolist())], dtype="float64")

    return docs.filter(score_of(F.coalesce(F.col(text_col), F.lit(""))) >= 0.5)
