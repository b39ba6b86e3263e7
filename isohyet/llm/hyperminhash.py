"""Near-duplicate documents by HyperMinHash.

1. A document is the set of its distinct word shingles, as 64-bit hashes. Equal
   sets are folded into one representative.
2. The set's HyperMinHash has one register per bucket: the leading zeros and the
   next mantissa bits of the bucket's smallest hash. Buckets without a shingle
   borrow the register of another one, chosen alike for all documents.
3. Registers are banded. In each bucket of equal bands every representative
   becomes a candidate of the one with the smallest id: a star, not all pairs.
4. Candidates whose Jaccard similarity, estimated from equal registers and
   corrected for chance collisions, is far too low are dropped; the others are
   verified on the full sets, which are rebuilt from the texts.
5. A bucket may hold several components then. Its members outside the largest
   one are compared with the others by their registers, in blocks, and plausible
   pairs join components into families. In a family, the members outside the
   largest component are verified against all others on the full sets, again in
   blocks. No pairs are written but the links that join components.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isohyet.llm.components import components
from isohyet.llm.texts import ascii_lower, id_and_text, map_texts, settled, words_of

BUCKET_BITS = 7
MANTISSA_BITS = 10
BANDS, BAND_BUCKETS = 32, 4
# Estimates further than this below the threshold are dropped: over five standard errors of 128 registers.
SLACK = 0.2
# Sets with fewer shingles are verified without an estimate.
SURE_SIZE = 200
BLOCK = 1_024  # members of a bucket or a family that one task compares at a time
CHUNK = 256  # candidates that share one copy of their centre's text
_MUL = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit numbers one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list[str]) -> np.ndarray:
    """64-bit hashes of words, the same in every process."""
    coded = [w.encode("utf-8", "surrogatepass") for w in words]
    return byte_hashes(np.frombuffer(b"".join(coded), np.uint8), np.fromiter(map(len, coded), np.int64, len(coded)))


def byte_hashes(raw: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The same hashes of words whose UTF-8 bytes follow each other in `raw`."""
    if not len(lengths):
        return np.empty(0, np.uint64)
    start = np.cumsum(lengths) - lengths
    place = np.arange(len(raw)) - np.repeat(start, lengths)
    power = np.cumprod(np.full(int(lengths.max()), _MUL, np.uint64))
    return mixed(np.add.reduceat((raw.astype(np.uint64) + np.uint64(1)) * power[place], start) + lengths.astype(np.uint64))


def shingle_sets(texts: list[str], size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a text with fewer words is one shingle, without words none."""
    words = [words_of(ascii_lower(t)) for t in texts]
    number: dict[str, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for ws in words for w in ws), np.int64)
    hashed = word_hashes(list(number))[ids] if len(ids) else np.empty(0, np.uint64)
    out, at = [], 0
    for ws in words:
        own = hashed[at:at + len(ws)]
        at += len(ws)
        n = min(size, len(own))
        joined = np.full(max(0, len(own) - n + 1) if n else 0, n, np.uint64)
        for k in range(n):
            joined = mixed(joined * _MUL + own[k:len(own) - n + 1 + k])
        out.append(np.unique(joined))
    return out


class Sketch:
    """HyperMinHash registers of 16 bits: 6 for the leading zeros and 10 of mantissa."""

    def __init__(self, bucket_bits: int = BUCKET_BITS):
        self.bits, self.n = bucket_bits, 1 << bucket_bits
        order = np.arange(self.n * self.n, dtype=np.uint64).reshape(self.n, self.n)
        self.lender = mixed(order + np.uint64(77)) >> np.uint64(1)
        np.fill_diagonal(self.lender, 0)  # a filled bucket keeps its own register

    def registers(self, hashes: np.ndarray) -> np.ndarray:
        """`hashes` sorted and not empty."""
        bucket = (hashes >> np.uint64(64 - self.bits)).astype(np.int64)
        filled, first = np.unique(bucket, return_index=True)
        rest = hashes[first] << np.uint64(self.bits)
        # Leading zeros by the exponent of the number's upper half, exact below 2^52.
        high = (rest >> np.uint64(12)).astype(np.float64)
        zeros = np.where(high > 0, 52 - np.frexp(high)[1], 52)
        body = rest << np.minimum(zeros + 1, 63).astype(np.uint64)
        value = (zeros.astype(np.uint64) << np.uint64(MANTISSA_BITS)) | (body >> np.uint64(64 - MANTISSA_BITS))
        if len(filled) == self.n:
            return value.astype("<u2")
        return value[np.argmin(self.lender[:, filled], axis=1)].astype("<u2")


def chance(n_a: np.ndarray, n_b: np.ndarray, buckets: int = 1 << BUCKET_BITS) -> np.ndarray:
    """Probability that registers of unrelated sets of these sizes are equal."""
    level = np.arange(53)[:, None]

    def share(n):
        rate = np.maximum(1.0, np.asarray(n, float) / buckets)[None, :]
        return np.exp(-rate * 2.0 ** -(level + 1)) - np.exp(-rate * 2.0 ** -level)

    return (share(n_a) * share(n_b)).sum(axis=0) / (1 << MANTISSA_BITS)


def estimate(equal: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, buckets: int = 1 << BUCKET_BITS) -> np.ndarray:
    """Jaccard similarity from the number of equal registers, corrected for chance collisions."""
    c = chance(n_a, n_b, buckets)
    return np.clip((equal / buckets - c) / (1 - c), 0.0, 1.0)


def sketches(docs: DataFrame, shingle: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_hash, n_shingles, a fingerprint of the set and its registers."""
    def start():
        sketch = Sketch()

        def work(keys, texts):
            sets = shingle_sets(texts, shingle)
            one = [int(np.bitwise_xor.reduce(s).astype(np.int64)) if len(s) else 0 for s in sets]
            two = [int(mixed(s + np.uint64(5)).sum().astype(np.int64)) if len(s) else 0 for s in sets]
            return [[k["doc_id"] for k in keys], [k["text_hash"] for k in keys], [len(s) for s in sets], one, two,
                    [sketch.registers(s).tobytes() if len(s) else None for s in sets]]

        return work

    return map_texts(hashed_texts(docs, id_col, text_col).select(F.struct("doc_id", "text_hash").alias("key"), "text"),
                     "doc_id long, text_hash long, n_shingles long, print_a long, print_b long, registers binary", start)


def hashed_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_hash, text: one id may have several texts."""
    return id_and_text(docs, id_col, text_col).withColumn("text_hash", F.xxhash64("text"))


def _plausible(threshold: float):
    """Keep candidate pairs that a verification could confirm."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            n_a, n_b = (np.asarray(batch.column(c)) for c in ("n_a", "n_b"))
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(len(n_a), -1) for c in ("r_a", "r_b"))
            keep = plausible((a == b).sum(axis=1), n_a, n_b, threshold, a.shape[1])
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(pa.array(keep)), batch.column("b").filter(pa.array(keep))],
                                             names=["a", "b"])

    return run


def _verify(percent: int, shingle: int):
    """Rows sorted by centre and chunk, the centre's own row first: the centre's set stays until the next one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, centre_set = None, None
        for batch in batches:
            centres, members = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            linked_a, linked_b = [], []
            texts = batch.column("text")
            for low in range(0, len(centres), 200):
                sets = shingle_sets(texts.slice(low, 200).to_pylist(), shingle)
                for a, b, s in zip(centres[low:low + 200], members[low:low + 200], sets):
                    if b is None:
                        centre, centre_set = a, s
                    elif a == centre:
                        both = len(np.intersect1d(centre_set, s, assume_unique=True))
                        if 100 * both >= percent * (len(centre_set) + len(s) - both):
                            linked_a.append(a), linked_b.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(linked_a, pa.int64()), pa.array(linked_b, pa.int64())], names=["a", "b"])

    return run


def groups_of(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables with the rows of one group each, from rows sorted by the keys."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = list(zip(*(batch.column(k).to_pylist() for k in keys)))
        start = 0
        for i, key in enumerate(columns):
            if key != last:
                if i > start:
                    held.append(batch.slice(start, i - start))
                if held:
                    yield pa.Table.from_batches(held)
                held, start, last = [], i, key
        held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


class Joiner:
    """Components of a group of rows, for emitting only links that join two of them."""

    def __init__(self, parts):
        self.up = {p: p for p in parts}

    def root(self, x):
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a, b) -> bool:
        a, b = self.root(a), self.root(b)
        self.up[a] = b
        return a != b


def _plausible_in_bucket(threshold: float):
    """Rows sorted by bucket and block. Plausible pairs between components, as far as they join components."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups_of(batches, ["key", "block"]):
            reps, parts = group.column("rep").to_pylist(), group.column("component").to_pylist()
            n = group.column("n_shingles").to_numpy()
            registers = np.frombuffer(b"".join(group.column("registers").to_pylist()), "<u2").reshape(len(reps), -1)
            number = {p: k for k, p in enumerate(dict.fromkeys(parts))}
            part = np.array([number[p] for p in parts])
            joiner, a, b = Joiner(parts), [], []
            for i in np.flatnonzero(group.column("other").to_numpy(zero_copy_only=False)):
                rows = np.flatnonzero((part != part[i]) & plausible(
                    (registers == registers[i]).sum(axis=1), np.full(len(n), n[i]), n, threshold, registers.shape[1]))
                # One row stands for each component that is met.
                for j in rows[np.unique(part[rows], return_index=True)[1]].tolist():
                    if joiner.join(parts[i], parts[j]):
                        a.append(reps[i]), b.append(reps[j])
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def plausible(equal: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, threshold: float, buckets: int) -> np.ndarray:
    """Whether a verification could confirm pairs with so many equal registers."""
    small, large = np.minimum(n_a, n_b), np.maximum(n_a, n_b)
    keep = small >= threshold * large - 1e-9
    keep[keep] = (estimate(equal[keep], n_a[keep], n_b[keep], buckets) >= threshold - SLACK) | (small[keep] < SURE_SIZE)
    return keep


def _verify_family(percent: int, shingle: int):
    """Rows sorted by family and block pair. Links between components, as far as they join components."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups_of(batches, ["family", "i", "j"]):
            reps, parts = group.column("rep").to_pylist(), group.column("component").to_pylist()
            asks = group.column("asks").to_pylist()
            texts, sets = group.column("text"), []
            for low in range(0, len(reps), 200):
                sets += shingle_sets(texts.slice(low, 200).to_pylist(), shingle)
            asked = [k for k in range(len(reps)) if not asks[k]]
            sizes = np.array([len(sets[k]) for k in asked])
            flat = np.concatenate([sets[k] for k in asked]) if asked else np.empty(0, np.uint64)
            order = np.argsort(flat, kind="stable")
            flat, owner = flat[order], np.repeat(np.arange(len(asked)), sizes)[order]
            joiner, a, b = Joiner(parts), [], []
            for k in (k for k in range(len(reps)) if asks[k]):
                low, high = np.searchsorted(flat, sets[k]), np.searchsorted(flat, sets[k], side="right")
                count = high - low
                at = np.repeat(low - np.r_[0, np.cumsum(count)[:-1]], count) + np.arange(count.sum())
                both = np.bincount(owner[at], minlength=len(asked))
                for m in np.flatnonzero(100 * both >= percent * (len(sets[k]) + sizes - both)).tolist():
                    other = asked[m]
                    if parts[other] != parts[k] and joiner.join(parts[k], parts[other]):
                        a.append(reps[k]), b.append(reps[other])
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row.

    Documents are linked when 100 * intersection >= percent * union of their
    shingle sets. component_id is the smallest doc_id reachable by links, kept
    is doc_id = component_id. Null and empty texts, and rows with a null id, are
    linked with nothing. Repeated rows of one id are linked with each other, and
    each with what its own text is similar to. Sets are compared by 64-bit hashes
    of their shingles.
    """
    print_ = ["n_shingles", "print_a", "print_b"]
    sets = settled(sketches(docs, shingle, id_col, text_col).withColumn("row", F.monotonically_increasing_id()))
    usable = sets.filter("n_shingles > 0 and doc_id is not null")
    # A set is known by the key of one of its rows: an id may have several sets.
    first_row = F.min(F.struct("row", "doc_id", "text_hash")).alias("first")
    folded = usable.groupBy(*print_).agg(first_row, F.min("doc_id").alias("low"), F.min("registers").alias("registers"))
    reps = settled(folded.select(*print_, F.col("first.row").alias("rep"), F.col("first.doc_id").alias("doc_id"),
                                 F.col("first.text_hash").alias("text_hash"), "low", "registers"))
    sketch_of = reps.select("rep", "n_shingles", "registers")
    width = 2 * BAND_BUCKETS
    bands = reps.select("rep", F.explode(F.array(*[
        F.xxhash64(F.lit(i), F.substring("registers", i * width + 1, width)) for i in range(BANDS)])).alias("key"))
    shared = bands.groupBy("key").agg(F.min("rep").alias("centre"), F.max("rep").alias("last")).filter("centre < last")
    buckets = settled(bands.join(shared.select("key", "centre"), "key").distinct())

    places, texts = reps.select("rep", "doc_id", "text_hash"), hashed_texts(docs, id_col, text_col)

    def texts_of(wanted: DataFrame) -> DataFrame:
        """rep, text of the wanted reps; repeated rows have one text."""
        place = places.join(wanted.distinct(), "rep", "left_semi")
        return texts.join(place, ["doc_id", "text_hash"]).groupBy("doc_id", "text_hash", "rep").agg(F.min("text").alias("text")).select("rep", "text")

    left, right = (sketch_of.select(F.col("rep").alias(k), F.col("n_shingles").alias(f"n_{k}"), F.col("registers").alias(f"r_{k}"))
                   for k in ("a", "b"))
    stars = buckets.filter("rep <> centre").select(F.col("centre").alias("a"), F.col("rep").alias("b")).distinct()
    likely = settled(stars.join(left, "a").join(right, "b").mapInArrow(_plausible(percent / 100), "a long, b long"))
    links = settled(_linked(likely, texts_of, percent, shingle).union(_same_id(usable, reps, print_)))
    first = components(links)
    families = _families(buckets, sketch_of, first, percent / 100)
    more = _linked_in_families(families, texts_of, percent, shingle)
    joined = components(links.union(more))
    of_rep = joined.select(F.col("id").alias("rep"), "component").join(reps.select("rep", "low"), "rep")
    lowest = of_rep.groupBy("component").agg(F.min("low").alias("component_id"))
    of_rep = of_rep.join(lowest, "component").select("rep", "component_id")
    whole = reps.join(of_rep, "rep", "left").select(*print_, F.coalesce("component_id", "low").alias("component_id"))
    return sets.join(whole, print_, "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNull() | (F.col("n_shingles") == 0), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _same_id(usable: DataFrame, reps: DataFrame, print_: list[str]) -> DataFrame:
    """Links (a, b) between the sets of ids that have several."""
    several = usable.groupBy("doc_id").agg(F.min(F.struct(*print_)).alias("low"), F.max(F.struct(*print_)).alias("high"))
    several = several.filter("low < high").select("doc_id")
    own = usable.select("doc_id", *print_).join(several, "doc_id").join(reps.select("rep", *print_), print_)
    own = settled(own.select("doc_id", "rep").distinct())
    least = own.groupBy("doc_id").agg(F.min("rep").alias("a"))
    return own.join(least, "doc_id").filter("a < rep").select("a", F.col("rep").alias("b"))


def _families(buckets: DataFrame, sketch_of: DataFrame, first: DataFrame, threshold: float) -> DataFrame:
    """rep, component, family of all representatives in families of several components."""
    placed = buckets.select("key", "rep").join(first.withColumnRenamed("id", "rep"), "rep", "left").withColumn(
        "component", F.coalesce("component", "rep"))
    main = placed.groupBy("key", "component").count().groupBy("key").agg(
        F.max_by("component", F.struct("count", "component")).alias("main"), F.count(F.lit(1)).alias("parts"),
        F.ceil(F.sum("count") / BLOCK).alias("blocks")).filter("parts > 1")
    apart = placed.join(main, "key").withColumn("other", F.col("component") != F.col("main")).join(sketch_of, "rep")
    # Those outside the largest component visit all blocks of their bucket.
    every = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    dealt = apart.withColumn("block", F.explode(F.when(F.col("other"), every).otherwise(F.array(F.pmod(F.xxhash64("rep"), "blocks")))))
    dealt = dealt.select("key", "block", "rep", "component", "other", "n_shingles", "registers")
    met = dealt.repartition("key", "block").sortWithinPartitions("key", "block").mapInArrow(
        _plausible_in_bucket(threshold), "a long, b long")
    met = settled(met.distinct())
    # A family joins whole components.
    part = first.select(F.col("id").alias("a"), F.col("component").alias("b"))
    touched = met.select(F.col("a").alias("id")).union(met.select(F.col("b").alias("id"))).distinct()
    own = touched.join(first, "id", "left").select(F.coalesce("component", "id").alias("b")).distinct()
    family = components(met.union(part.join(own, "b", "left_semi").select("a", "b")))
    family = family.withColumnsRenamed({"id": "rep", "component": "family"})
    return settled(family.join(first.withColumnRenamed("id", "rep"), "rep", "left").select(
        "rep", "family", F.coalesce("component", "rep").alias("component")))


def _linked_in_families(families: DataFrame, texts_of: Callable[[DataFrame], DataFrame], percent: int, shingle: int) -> DataFrame:
    """Verified links between the components of each family."""
    sizes = families.groupBy("family", "component").count().groupBy("family").agg(
        F.max_by("component", F.struct("count", "component")).alias("main"), F.count(F.lit(1)).alias("parts"),
        F.ceil(F.sum("count") / BLOCK).alias("blocks")).filter("parts > 1")
    members = families.join(sizes, "family").withColumn("own", F.pmod(F.xxhash64("rep"), "blocks"))
    members = members.join(texts_of(members.select("rep")), "rep")
    every = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    columns = ["family", "i", "j", "rep", "component", "asks", "text"]
    # Block i asks (its members outside the largest component), block j is asked (all its members).
    asking = members.filter("component <> main").withColumns({"i": F.col("own"), "j": F.explode(every), "asks": F.lit(True)})
    asked_by = asking.select("family", "i").distinct()
    asked = members.join(asked_by, "family").withColumns({"j": F.col("own"), "asks": F.lit(False)})
    rows = asking.select(columns).union(asked.select(columns))
    return settled(rows.repartition("family", "i", "j").sortWithinPartitions("family", "i", "j").mapInArrow(
        _verify_family(percent, shingle), "a long, b long"))


def _linked(pairs: DataFrame, texts_of: Callable[[DataFrame], DataFrame], percent: int, shingle: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough. Texts of documents without a pair are left out at once."""
    sizes = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / CHUNK).alias("chunks"))
    edges = pairs.join(sizes, "a").select("a", "b", F.pmod(F.xxhash64("b"), "chunks").alias("chunk"))
    rows = edges.select("a", "chunk", "b", F.col("b").alias("rep")).union(
        edges.select("a", "chunk").distinct().select("a", "chunk", F.lit(None).cast("long"), F.col("a")))
    placed = rows.join(texts_of(rows.select("rep")), "rep").select("a", "chunk", "b", "text")
    placed = placed.repartition("a", "chunk").sortWithinPartitions("a", "chunk", F.col("b").asc_nulls_first())
    return placed.mapInArrow(_verify(percent, shingle), "a long, b long")
