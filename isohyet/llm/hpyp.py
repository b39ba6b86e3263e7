"""Language-model scores with a hierarchical Pitman-Yor model.

The words after one context form a restaurant; all context restaurants share
the restaurant of single words as their parent, whose own parent is uniform
over the vocabulary and one unknown word. A context is a class of the word
before: one of a fixed number of hash classes, so that frequent words have
restaurants nearly of their own and rare ones share.

1. Tasks turn texts into blocks of word and context numbers, one row per block
   and range of words (a shard). Blocks are stored in the shared folder.
2. Training counts meet by shard. All contexts of a word lie in one shard, so a
   word's customers in the parent restaurant are counted without a further shuffle.
3. Gibbs rounds: in every shard, every customer stands up and is seated anew, first in
   the context restaurants, then in the parent. The totals per restaurant (a fixed
   number) are summed over the shards and handed out for the next round.
4. After the burn-in, each round is a sample. A token's probability is the mean
   over the samples; its logarithms are summed per document.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isohyet.llm import restaurants
from isohyet.llm.hyperminhash import byte_hashes
from isohyet.llm.subword_embedding import held_out
from isohyet.llm.texts import chunks, discard, id_and_text, scratch, settled

CLASSES = 1 << 16
BLOCK_CHARS = 8_000_000
PIECE = 1 << 18  # bytes whose words are hashed at a time
SHARD_BYTES = 24_000_000  # of text for each shard
MOST_SHARDS = 1 << 16
BURN_IN, SAMPLES = 2, 3
# Customers of the parent restaurant that come or go one by one in a round, per dish.
STEPS = 8
STRENGTH, PARENT_STRENGTH = 1.0, 1.0
END = np.uint64(0x0123456789ABCDEF)
START_CLASS = 12_345
# Bytes of words: all but the white space that separates them.
IN_WORD = ~np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
SEED = 20


def pack(**arrays: np.ndarray) -> bytes:
    """Arrays as one compressed value: repeated counts and sorted numbers take a fraction of their room."""
    out = io.BytesIO()
    np.savez(out, **arrays)
    return zstandard.ZstdCompressor(level=1).compress(out.getbuffer())


def unpack(data: bytes, prefix: str = "") -> dict[str, np.ndarray]:
    """The arrays whose names begin with the prefix."""
    with np.load(io.BytesIO(zstandard.ZstdDecompressor().decompress(data))) as f:
        return {k: f[k] for k in f.files if k.startswith(prefix)}


def narrow(x: np.ndarray) -> np.ndarray:
    """The same numbers in the smallest unsigned type."""
    return x.astype(np.min_scalar_type(int(x.max(initial=0))))


class Block:
    """Documents of a task as arrays, until they are given out by shard."""

    def __init__(self, number: int):
        self.number, self.chars = number, 0
        self.parts: list[np.ndarray] = []
        self.docs: list = []
        self.sizes: list[np.ndarray] = []
        self.train: list[np.ndarray] = []

    def add(self, ids: list, held: np.ndarray, texts: list[bytes], chars: int) -> None:
        hashed, sizes = token_hashes(texts)
        self.parts.append(hashed), self.sizes.append(sizes), self.train.append(~held)
        self.docs += ids
        self.chars += chars

    def rows(self, shards: int) -> Iterator[tuple[int, bytes]]:
        """(shard, places of all tokens, with how often each pair stands in training); shard -1 has the documents."""
        sizes, train = np.concatenate(self.sizes), np.concatenate(self.train)
        yield -1, pack(ids=np.array([0 if d is None else d for d in self.docs], np.int64),
                       missing=np.array([d is None for d in self.docs]), sizes=sizes, train=train)
        n = int(sizes.sum()) + len(sizes)
        ends = np.cumsum(sizes + 1) - 1
        word = np.empty(n, np.uint64)
        word[ends] = END
        is_word = np.ones(n, bool)
        is_word[ends] = False
        word[is_word] = np.concatenate(self.parts)
        # The class of the word before; a document's first token follows its start.
        context = np.empty(n, np.int64)
        context[1:] = word[:-1] & np.uint64(CLASSES - 1)
        context[0] = START_CLASS
        context[ends[:-1] + 1] = START_CLASS
        doc = np.repeat(np.arange(len(sizes)), sizes + 1)
        hashed, rank = np.unique(word, return_inverse=True)
        key, doc = by_key(rank * CLASSES + context, doc)
        train = train[doc]
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        times, trained = np.diff(np.r_[first, n]), np.add.reduceat(train.astype(np.int64), first)
        pair = key[first]
        word_of = pair // CLASSES
        shard_of_word = shard_of(hashed, shards)
        cuts = np.searchsorted(shard_of_word[word_of], np.arange(shards + 1))
        token = np.r_[first, n]
        for s in range(shards):
            a, b = int(cuts[s]), int(cuts[s + 1])
            if a == b:
                continue
            own, which = np.unique(word_of[a:b], return_index=True)
            per_word = np.diff(np.r_[which, b - a])
            classes = (pair[a:b] % CLASSES).astype(np.uint16)
            yield s, pack(words=hashed[own], per_word=narrow(per_word), classes=classes, times=narrow(times[a:b]),
                          trained=narrow(trained[a:b]), doc=narrow(doc[token[a]:token[b]]), n_docs=np.array([len(sizes)]))


def token_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in order, and how many each text has; bytes.lower() changes A-Z alone."""
    raw = np.frombuffer(b" ".join(texts).lower() + b" ", np.uint8)
    inside = IN_WORD[raw]
    edges = np.flatnonzero(np.diff(inside, prepend=False))
    starts, stops = edges[::2], edges[1::2]
    text_ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    hashed = [np.empty(0, np.uint64)]
    cuts = np.r_[np.searchsorted(starts, np.arange(0, len(raw), PIECE)), len(starts)]
    for a, b in zip(cuts[:-1], cuts[1:]):
        if a < b:
            own = slice(starts[a], stops[b - 1])
            hashed.append(byte_hashes(raw[own][inside[own]], stops[a:b] - starts[a:b]))
    return np.concatenate(hashed), np.diff(np.searchsorted(starts, text_ends), prepend=0)


def by_key(key: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both sorted by key, then document (`doc` is sorted): as one number where that has room."""
    bits = int(doc[-1]).bit_length()
    if bits + int(key.max()).bit_length() > 63:
        order = np.argsort(key, kind="stable")
        return key[order], doc[order]
    both = (key << bits) | doc
    both.sort()
    return both >> bits, both & ((1 << bits) - 1)


def shard_of(hashed: np.ndarray, shards: int) -> np.ndarray:
    """Ranges of the hash, so that words sorted by hash are sorted by shard."""
    return ((hashed >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def blocks_of(docs: DataFrame, shards: int, block_chars: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0

        def give(block: Block) -> Iterator[pa.RecordBatch]:
            for shard, places in block.rows(shards):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard], pa.int32()), pa.array([block.number], pa.int64()), pa.array([places], pa.binary())],
                    names=["shard", "block", "places"])

        block = Block(task << 32)
        for batch in batches:
            texts = batch.column(1)
            for low, high in chunks(texts):
                part = batch.slice(low, high - low)
                block.add(part.column(0).to_pylist(), part.column(2).to_numpy(zero_copy_only=False),
                          part.column(1).cast(pa.binary()).to_pylist(), pc.sum(pc.utf8_length(part.column(1))).as_py())
                if block.chars >= block_chars:
                    yield from give(block)
                    made += 1
                    block = Block((task << 32) + made)
        if block.docs:
            yield from give(block)

    rows = id_and_text(docs).withColumn("held", held_out(F.col("doc_id"), 10, 0))
    return rows.mapInArrow(run, "shard int, block long, places binary")


def training_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(shard, counts) of each block that has training tokens of the shard: its pairs without their places."""
    for batch in batches:
        for shard, data in zip(batch.column("shard").to_pylist(), batch.column("places")):
            p = unpack(data.as_py())
            seen = p["trained"] > 0
            if not seen.any():
                continue
            first = np.cumsum(p["per_word"], dtype=np.int64) - p["per_word"]
            counts = pack(words=p["words"], per_word=narrow(np.add.reduceat(seen.astype(np.int64), first)), classes=p["classes"][seen], n=p["trained"][seen])
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([counts], pa.binary())], names=["shard", "counts"])


def counts_by_shard(blocks: DataFrame) -> DataFrame:
    """One row per shard with training tokens, as merge_counts() gives it."""
    counts = blocks.filter("shard >= 0").select("shard", "places").mapInArrow(training_counts, "shard int, counts binary")
    return counts.groupBy("shard").applyInArrow(
        merge_counts, "shard int, table binary, state binary, tokens long, words long, once long, twice long, totals binary")


def merge_counts(group: pa.Table) -> pa.Table:
    """Training counts of one shard: the full table, and what the Gibbs rounds need."""
    parts = [unpack(c) for c in group.column("counts").to_pylist()]
    words = np.unique(np.concatenate([p["words"] for p in parts]))
    key, n = [], []
    for p in parts:
        key.append(np.repeat(np.searchsorted(words, p["words"]), p["per_word"]) * CLASSES + p["classes"])
        n.append(p["n"].astype(np.int64))
    del parts
    key, n = np.concatenate(key), np.concatenate(n)
    order = np.argsort(key)
    key, n = key[order], n[order]
    del order
    first = np.flatnonzero(np.diff(key, prepend=-1))
    key, n = key[first], np.add.reduceat(n, first)
    word, classes = key // CLASSES, key % CLASSES
    per_word = np.bincount(word, minlength=len(words))
    used = per_word > 0
    words, per_word = words[used], per_word[used]
    word = np.repeat(np.arange(len(words)), per_word)
    many = n > 1
    return pa.table({
        "shard": pa.array([group.column("shard")[0].as_py()], pa.int32()),
        "table": pa.array([pack(words=words, per_word=narrow(per_word), classes=classes.astype(np.uint16), n=narrow(n))], pa.binary()),
        "state": pa.array([pack(word=narrow(word[many]), classes=classes[many].astype(np.uint16), n=narrow(n[many]),
                                singles=narrow(np.bincount(word[~many], minlength=len(words))))], pa.binary()),
        "tokens": [int(n.sum())], "words": [len(words)], "once": [int((n == 1).sum())], "twice": [int((n == 2).sum())],
        "totals": pa.array([pack(customers=np.bincount(classes, weights=n, minlength=CLASSES).astype(np.int64),
                                 singles=np.bincount(classes[~many], minlength=CLASSES))], pa.binary()),
    })


def add_totals(group: pa.Table) -> pa.Table:
    """Sums the arrays of several shards."""
    total: dict[str, np.ndarray] = {}
    for data in group.column("totals").to_pylist():
        for k, v in unpack(data).items():
            total[k] = total.get(k, 0) + v
    return pa.table({"totals": pa.array([pack(**total)], pa.binary())})


def summed(table: DataFrame, shards: int) -> dict[str, np.ndarray]:
    """The arrays of `totals` over all shards: groups of shards first, so that few rows of a fixed size arrive."""
    groups = max(1, int(shards ** 0.5))
    rows = table.select((F.col("shard") % groups).alias("g"), "totals").groupBy("g").applyInArrow(add_totals, "totals binary").collect()
    total: dict[str, np.ndarray] = {}
    for row in rows:
        for k, v in unpack(row[0]).items():
            total[k] = total.get(k, 0) + v
    return total


class Levels:
    """Discounts, strengths and the totals that a Gibbs round needs; a fixed number of values."""

    def __init__(self, discount, parent_discount, vocabulary, customers, tables, parent_customers, parent_tables):
        self.discount, self.parent_discount, self.vocabulary = discount, parent_discount, vocabulary
        self.customers, self.tables = customers, tables
        self.parent_customers, self.parent_tables = parent_customers, parent_tables

    def parent(self, customers, tables):
        """Probability of words in the parent restaurant."""
        base = (PARENT_STRENGTH + self.parent_discount * self.parent_tables) / (self.vocabulary + 1)
        return (np.maximum(customers - self.parent_discount * tables, 0) + base) / (PARENT_STRENGTH + self.parent_customers)

    def new_table(self):
        """Weight of a new table per restaurant, before the parent's probability."""
        return STRENGTH + self.discount * self.tables


def _seat_anew(rng, size, owner, customers, weight, discount: float):
    """Dishes whose customers have changed by more than a few start again; for the others one after the other comes or goes."""
    change = np.abs(customers - np.bincount(owner, weights=size, minlength=len(customers)).astype(np.int64))
    anew = np.flatnonzero(change > STEPS)
    if not len(anew):
        return size, owner
    kept = change[owner] <= STEPS
    new_size, new_owner = restaurants.first_seating(rng, customers[anew], weight[anew], discount)
    size, owner = np.r_[size[kept], new_size], np.r_[owner[kept], anew[new_owner]]
    order = np.argsort(owner, kind="stable")
    return size[order], owner[order]


def gibbs_round(state: dict[str, np.ndarray], levels: Levels, shard: int, number: int, sample: bool) -> dict[str, np.ndarray]:
    """One round in a shard. The totals of other shards are those of the last round."""
    rng = np.random.default_rng((SEED, shard, number))
    word, classes, n = (state[k].astype(np.int64) for k in ("word", "classes", "n"))
    singles = state["singles"].astype(np.int64)
    words = len(singles)
    weight = levels.new_table()[classes]
    parent_weight = np.full(words, (PARENT_STRENGTH + levels.parent_discount * levels.parent_tables) / (levels.vocabulary + 1))
    if "size" in state:
        size, owner = state["size"].astype(np.int64), np.repeat(np.arange(len(n)), state["tables"])
        parent_size, parent_owner = state["parent_size"].astype(np.int64), np.repeat(np.arange(words), state["parent_tables"])
        customers = np.bincount(parent_owner, weights=parent_size, minlength=words)
        p = levels.parent(customers, np.bincount(parent_owner, minlength=words))
    else:
        total = np.bincount(word, weights=n, minlength=words) + singles
        p = total / max(1.0, levels.customers.sum())
        size, owner = restaurants.first_seating(rng, n, weight * p[word], levels.discount)
        start = singles + np.bincount(word[owner], minlength=words)
        parent_size, parent_owner = restaurants.first_seating(rng, start, parent_weight, levels.parent_discount)
    size, owner = restaurants.sweep_all(rng, size, owner, weight * p[word], levels.discount)
    # Every table of a context is a customer of the parent.
    tables = np.bincount(owner, minlength=len(n))
    customers = singles + np.bincount(word, weights=tables, minlength=words).astype(np.int64)
    parent_size, parent_owner = _seat_anew(rng, parent_size, parent_owner, customers, parent_weight, levels.parent_discount)
    while True:
        change = customers - np.bincount(parent_owner, weights=parent_size, minlength=words).astype(np.int64)
        if not change.any():
            break
        if (change > 0).any():
            parent_size, parent_owner = restaurants.add(rng, parent_size, parent_owner, np.flatnonzero(change > 0), parent_weight, levels.parent_discount)
        if (change < 0).any():
            parent_size, parent_owner = restaurants.remove(rng, parent_size, parent_owner, np.flatnonzero(change < 0))
    parent_size, parent_owner = restaurants.sweep_all(rng, parent_size, parent_owner, parent_weight, levels.parent_discount)
    parent_tables = np.bincount(parent_owner, minlength=words)
    out = {k: state[k] for k in state if k in ("word", "classes", "n", "singles") or k.startswith("sample_")}
    out |= {"size": narrow(size), "tables": narrow(tables), "parent_size": narrow(parent_size), "parent_tables": narrow(parent_tables)}
    if sample:
        out |= {f"sample_tables_{number}": narrow(tables), f"sample_customers_{number}": narrow(customers),
                f"sample_parents_{number}": narrow(parent_tables)}
    out["totals"] = np.frombuffer(pack(
        tables=np.bincount(classes, weights=tables, minlength=CLASSES).astype(np.int64), parent_tables=np.array([parent_tables.sum()]),
        once=np.array([(customers == 1).sum()]), twice=np.array([(customers == 2).sum()])), np.uint8)
    return out


def discount_of(once: int, twice: int) -> float:
    """The usual estimate from what was seen once and twice."""
    return min(0.95, max(0.05, once / (once + 2 * twice))) if once else 0.5


def sample_seating(counted: DataFrame, shards: int) -> tuple[DataFrame, list[Levels], int, int]:
    """Gibbs rounds over all shards: (shard, state), the levels of every sample, training tokens and words."""
    spark = counted.sparkSession
    sums = counted.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tokens", "words", "once", "twice")]).first()
    totals = summed(counted, shards)
    none = np.zeros(CLASSES, np.int64)
    customers, singles = totals.get("customers", none), totals.get("singles", none)
    discount = discount_of(sums["once"], sums["twice"])
    # Before the first seating: every pair seen once has a table, the others a share.
    guess = singles + (customers - singles) * 0.5
    levels = Levels(discount, 0.5, sums["words"], customers, guess, float(guess.sum()), float(sums["words"]))
    state = counted.select("shard", "state")
    samples, folder = [], None
    for number in range(BURN_IN + SAMPLES):
        shared = spark.sparkContext.broadcast(levels)  # two arrays of CLASSES numbers

        def run(batches, number=number, shared=shared):
            for batch in batches:
                for shard, data in zip(batch.column("shard").to_pylist(), batch.column("state").to_pylist()):
                    out = gibbs_round(unpack(data), shared.value, shard, number, number >= BURN_IN)
                    own = out.pop("totals").tobytes()
                    if number == BURN_IN + SAMPLES - 1:
                        out = {k: v for k, v in out.items() if k.startswith("sample_")}
                    yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([pack(**out)], pa.binary()),
                                                      pa.array([own], pa.binary())], names=["shard", "state", "totals"])

        before, folder = folder, scratch(spark)
        done = settled(state.mapInArrow(run, "shard int, state binary, totals binary"), folder)
        totals = summed(done, shards)
        if before:
            discard(spark, before)
        tables = singles + totals.get("tables", none)
        parent_discount = discount_of(*(int(totals.get(k, np.zeros(1)).sum()) for k in ("once", "twice")))
        levels = Levels(discount, parent_discount, sums["words"], customers, tables, float(tables.sum()),
                        float(totals.get("parent_tables", np.zeros(1)).sum()))
        if number >= BURN_IN:
            samples.append(levels)
        state = done.select("shard", "state")
    return state, samples, sums["tokens"], sums["words"]


class Scorer:
    """Logarithms of mean predictive probabilities for the words of a shard."""

    def __init__(self, table: bytes | None, state: bytes | None, samples: list[Levels]):
        self.samples = samples
        empty = np.empty(0, np.int64)
        t = unpack(table) if table else {"words": np.empty(0, np.uint64), "per_word": empty, "classes": empty, "n": empty}
        s = unpack(state, "sample_") if state else {}
        self.words = t["words"]
        word = np.repeat(np.arange(len(self.words), dtype=np.int64), t["per_word"])
        self.key = word * CLASSES + t["classes"]
        self.n = t["n"]  # these stay in narrow types: a shard has many pairs
        self.count = np.bincount(word, weights=self.n, minlength=len(self.words))
        many = self.n > 1
        self.tables, self.parent = [], []
        for i, levels in enumerate(samples):
            tables = np.ones(len(self.n), s[f"sample_tables_{BURN_IN + i}"].dtype if s else np.uint8)
            parent = levels.parent(np.zeros(len(self.words) + 1), np.zeros(len(self.words) + 1))  # the last: unknown words
            if s:
                tables[many] = s[f"sample_tables_{BURN_IN + i}"]
                parent[:-1] = levels.parent(s[f"sample_customers_{BURN_IN + i}"].astype(float), s[f"sample_parents_{BURN_IN + i}"].astype(float))
            self.tables.append(tables), self.parent.append(parent)

    def score(self, places: bytes):
        """Per document of a block: log10 probability, sum of log10(count + 0.1), known tokens."""
        p = unpack(places)
        at = np.minimum(np.searchsorted(self.words, p["words"]), max(0, len(self.words) - 1))
        known = self.words[at] == p["words"] if len(self.words) else np.zeros(len(p["words"]), bool)
        index = np.repeat(np.where(known, at, len(self.words)), p["per_word"])
        classes = p["classes"].astype(np.int64)
        key = index * CLASSES + classes
        pair = np.minimum(np.searchsorted(self.key, key), max(0, len(self.key) - 1))
        seen = self.key[pair] == key if len(self.key) else np.zeros(len(key), bool)
        mean = np.zeros(len(key))
        for levels, tables, parent in zip(self.samples, self.tables, self.parent):
            own = np.where(seen, self.n[pair] - levels.discount * tables[pair], 0.0) if len(self.key) else 0.0
            mean += (own + levels.new_table()[classes] * parent[index]) / (STRENGTH + levels.customers[classes])
        logs = np.log10(mean / len(self.samples))
        base = np.log10(np.r_[self.count, 0.0] + 0.1)[index]
        times, docs = p["times"].astype(np.int64), p["doc"].astype(np.int64)
        n = int(p["n_docs"][0])
        return tuple(np.bincount(docs, weights=np.repeat(x, times), minlength=n) for x in (logs, base, (index < len(self.words)).astype(float)))


def _score_blocks(shared):
    """Rows sorted by shard, its model first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, scorer = None, None
        for batch in batches:
            for i, (shard, block) in enumerate(zip(batch.column("shard").to_pylist(), batch.column("block").to_pylist())):
                if shard != current:
                    current, scorer = shard, None
                one = batch.column("one")[i].as_py()
                if block is None:
                    scorer = Scorer(one, batch.column("two")[i].as_py(), shared.value)
                    continue
                scorer = scorer or Scorer(None, None, shared.value)
                score, base, known = scorer.score(one)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block], pa.int64()), pa.array([score.tobytes()]), pa.array([base.tobytes()]),
                     pa.array([known.astype(np.uint32).tobytes()])], names=["block", "score", "base", "known"])

    return run


def by_shard(rows: DataFrame, shards: int) -> DataFrame:
    """One shard per partition, so that no Arrow batch holds those of several; its model first, then its blocks."""
    return rows.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", F.col("block").asc_nulls_first())


def _documents(tokens: int, words: int):
    """One block: its documents with the sums over all shards."""
    def run(group: pa.Table) -> pa.Table:
        score = base = known = 0
        docs = None
        for row in group.to_pylist():
            if row["docs"] is not None:
                docs = unpack(row["docs"])
            else:
                score = score + np.frombuffer(row["score"])
                base = base + np.frombuffer(row["base"])
                known = known + np.frombuffer(row["known"], np.uint32).astype(np.int64)
        n = docs["sizes"] + 1
        return pa.table({
            "doc_id": pa.array(docs["ids"], pa.int64(), mask=docs["missing"]), "held_out": ~docs["train"], "n_tokens": n, "n_known": known,
            "train_tokens": np.full(len(n), tokens, np.int64), "base_score": base - n * np.log10(tokens + 0.1 * (words + 1)), "score": score})

    return run


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = SHARD_BYTES,
                block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row.

    A null or empty text has the end token alone. A null id is not held out.
    Repeated rows train and score like any others, other columns are left out.
    Without training documents every token has probability 1. Words are told
    apart by 64-bit hashes.
    """
    spark = docs.sparkSession
    texts = id_and_text(docs, id_col, text_col)
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    shards = int(min(MOST_SHARDS, max(1, -(-size // shard_bytes))))
    blocks = settled(blocks_of(texts, shards, block_chars))
    counted = settled(counts_by_shard(blocks))
    state, samples, tokens, words = sample_seating(counted, shards)
    if not samples:
        raise ValueError("at least one sample is needed")
    shared = spark.sparkContext.broadcast(samples)
    models = counted.select("shard", "table").join(state, "shard").select(
        "shard", F.lit(None).cast("long").alias("block"), F.col("table").alias("one"), F.col("state").alias("two"))
    places = blocks.filter("shard >= 0").select("shard", "block", F.col("places").alias("one"), F.lit(None).cast("binary").alias("two"))
    partial = by_shard(models.union(places), shards).mapInArrow(_score_blocks(shared), "block long, score binary, base binary, known binary")
    none = F.lit(None).cast("binary")
    both = partial.withColumn("docs", none).union(blocks.filter("shard = -1").select(
        "block", none.alias("score"), none.alias("base"), none.alias("known"), F.col("places").alias("docs")))
    return both.groupBy("block").applyInArrow(
        _documents(tokens, words), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
