"""How the sources of a language differ in their words, by run-length columns.

Every source is a column of counts over the language's kept terms. The vocabulary
is reordered so that equal counts cluster: terms with the same counts in all
sources become one row with a multiplicity, and rows are sorted by their counts. Each column
of a block of the vocabulary is run-length encoded; a pair of columns is compared
on the intersections of their runs, f times the length of the intersection.

Counts are combined in the tasks before the first shuffle, terms with equal counts before the second, so
neither a frequent term nor a third of all terms with one count lands in a task as
rows of its own. A row of the vocabulary holds at most one entry per source; the
result itself has one row per pair of sources. Blocks grow in number with the vocabulary.

Defined cases: null text, lang and source are ''. Repeated rows are documents of
their own. A group without terms counts as all zeros; a language without kept
terms has pairs of value 0. No documents: no rows. Other columns are left out. Equal values are ranked by the UTF-8 order of the item.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from isohyet.llm.texts import arrow_schema, settled
from pyspark.sql import types as T

SCALE = 1_000_000_000
# Bytes that end a term become spaces, A-Z lower case; all bytes of other characters belong to terms.
_TABLE = bytes(b if b > 0x7F or chr(b).islower() else b + 32 if chr(b).isupper() else 32 for b in range(256))
# Entries that a task holds before it hands its counts on.
HELD = 400_000
# Kept terms of a block of the vocabulary.
BLOCK_TERMS = 50_000
# Parts of a group's terms that are ranked apart before the last ranking.
RANK_PARTS = 32
MIN_DOCS, TOP_TERMS = 3, 200


def terms_of(text: bytes) -> list[bytes]:
    """Terms of a UTF-8 text, A-Z lower-cased."""
    return text.translate(_TABLE).split()


COUNTS = T.StructType().add("lang", "string").add("source", "string").add("term", "string").add("n", "long").add("docs", "long")


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = arrow_schema(COUNTS)
    held: dict[tuple, tuple[Counter, Counter]] = {}

    def flushed():
        for (lang, source), (n, docs) in held.items():
            terms = list(n)
            for low in range(0, len(terms), 50_000):
                part = terms[low:low + 50_000]
                k = len(part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * k, pa.string()), pa.array([source] * k, pa.string()), pa.array(part, pa.binary()).cast(pa.string()),
                     pa.array([n[t] for t in part], pa.int64()), pa.array([docs[t] for t in part], pa.int64())], schema=schema)
        held.clear()

    for batch in batches:
        texts = batch.column(2)
        for i, group in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
            terms = terms_of(texts[i].as_py())
            n, docs = held.setdefault(group, (Counter(), Counter()))
            n.update(terms)
            docs.update(set(terms))
        if sum(len(n) for n, _ in held.values()) > HELD:
            yield from flushed()
    yield from flushed()


def _groups(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"))


def vocabulary(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """lang, term, total, counts (source, n in source order) of the terms in at least `min_docs` documents of their language."""
    rows = docs.select(F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"),
                       F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    # Hashed by the fewest keys, so both groupings share one shuffle.
    counts = rows.mapInArrow(_counted, COUNTS).repartition("lang", "term").groupBy("lang", "term", "source").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    return counts.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.sort_array(F.collect_list(F.struct("source", "n"))).alias("counts"),
    ).filter(F.col("docs") >= min_docs).drop("docs")


def _sizes(docs: DataFrame, words: DataFrame) -> DataFrame:
    """lang, source, n_group, n_lang, n_terms for every group that occurs."""
    by_group = words.select("lang", F.explode("counts").alias("c")).groupBy("lang", "c.source").agg(F.sum("c.n").alias("n_group"))
    by_lang = words.groupBy("lang").agg(F.sum("total").alias("n_lang"), F.count("*").alias("n_terms"))
    groups = _groups(docs).distinct().join(by_group, ["lang", "source"], "left").join(by_lang, "lang", "left")
    return groups.select("lang", "source", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_group", "n_lang", "n_terms")])


def _share(count: str, total: str) -> str:
    """SQL of p in billionths, smoothed by one; exact."""
    return f"1 + (cast({SCALE} as decimal(10, 0)) * (cast({count} as decimal(19, 0)) + 1)) div cast({total} + n_terms as decimal(20, 0))"


def term_rows(words: DataFrame, sizes: DataFrame, top: int = TOP_TERMS) -> DataFrame:
    """The `top` terms of each group that are more frequent in it than in its language."""
    own = words.select("lang", "term", "total", F.explode("counts").alias("c")).select("lang", "term", "total", "c.*").join(sizes, ["lang", "source"])
    shares = own.select("lang", "source", F.col("term").alias("item"), F.expr(_share("n", "n_group")).alias("p"), F.expr(_share("total", "n_lang")).alias("q"))
    found = shares.filter("p > q").select("lang", "source", "item", F.expr("((p - q) * (p - q)) div q").alias("value"))
    order = [F.desc("value"), F.asc("item")]
    part = F.pmod(F.xxhash64("item"), F.lit(RANK_PARTS)).alias("part")
    first = found.select("*", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(*order)))
    last = first.filter(F.col("rank") <= top).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(*order)))
    return last.filter(F.col("rank") <= top).select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")


class Runs:
    """A run-length encoded column: where runs of equal counts begin, and the share p of each."""

    def __init__(self, at: np.ndarray, counts: np.ndarray, begins: np.ndarray, total: int):
        """`at`, `counts`: rows of the block with a count and the count; `begins`: first term of each row, then the number of terms."""
        rows, edge = len(begins) - 1, at + 1
        # A run begins at a row whose neighbour before is no row with the same count, and behind a row that has no neighbour.
        fresh = np.ones(len(at), bool)
        fresh[1:] = (at[1:] != edge[:-1]) | (counts[1:] != counts[:-1])
        ends = np.ones(len(at), bool)
        ends[:-1] = at[1:] != edge[:-1]
        ends &= edge < rows
        first = [] if len(at) and at[0] == 0 else [0]
        starts = np.concatenate([np.array(first, np.int64), at[fresh], edge[ends]])
        values = np.concatenate([np.zeros(len(first), np.int64), counts[fresh], np.zeros(int(ends.sum()), np.int64)])
        order = np.argsort(starts, kind="stable")
        self.starts = begins[starts[order]]
        # Products beyond 64 bits, so in Python; equal counts are worked out once.
        distinct, inverse = np.unique(values[order], return_inverse=True)
        self.p = np.array([1 + SCALE * (int(c) + 1) // total for c in distinct], np.int64)[inverse]


def _weighted(f: np.ndarray, lengths: np.ndarray) -> int:
    """Sum of f times length without overflow."""
    return (int(((f >> 30) * lengths).sum()) << 30) + int(((f & (1 << 30) - 1) * lengths).sum())


def pair_values(a: Runs, b: Runs, terms: int) -> tuple[int, int]:
    """Sum of f over all terms, with p of a and q of b, and the other way round."""
    starts = np.union1d(a.starts, b.starts)
    lengths = np.diff(starts, append=terms)
    p = a.p[np.searchsorted(a.starts, starts, side="right") - 1]
    q = b.p[np.searchsorted(b.starts, starts, side="right") - 1]
    square = (p - q) ** 2
    return _weighted(square // q, lengths), _weighted(square // p, lengths)


PAIRS = T.StructType().add("lang", "string").add("source", "string").add("item", "string").add("value", "long")


def _block_pairs(head: list[tuple], rows: list[pa.RecordBatch], lang: str) -> Iterator[pa.RecordBatch]:
    """Values of all pairs of sources over one block; `head`: (source, n_group, n_terms)."""
    schema = arrow_schema(PAIRS)
    names = [h[0] for h in head]
    table = pa.Table.from_batches(rows).combine_chunks() if rows else None
    if table is None or not len(table):
        columns, terms = [], 0
    else:
        lists = table.column("counts").chunk(0)
        begins = np.concatenate([[0], np.cumsum(table.column("terms").to_numpy())])
        terms = int(begins[-1])
        row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
        cells = lists.flatten()
        source = pa.compute.index_in(cells.field("source"), pa.array(names, pa.string())).to_numpy()
        count = cells.field("n").to_numpy()
        order = np.argsort(source, kind="stable")
        row, count = row[order], count[order]
        cuts = np.searchsorted(source[order], np.arange(len(names) + 1))
        columns = [Runs(row[low:high], count[low:high], begins, n + v) for low, high, (_, n, v) in zip(cuts, cuts[1:], head)]
    for i, name in enumerate(names):
        there = [pair_values(columns[i], columns[j], terms) if terms else (0, 0) for j in range(i)]
        items = names[:i]
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * 2 * i, pa.string()), pa.array([name] * i + items, pa.string()), pa.array(items + [name] * i, pa.string()),
             pa.array([a for a, _ in there] + [b for _, b in there], pa.int64())], schema=schema)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks arrive whole and sorted: the sources of the language first, then the rows of the block."""
    block, head, rows = None, [], []
    for batch in batches:
        keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()))
        low = 0
        while low < len(keys):
            high = low + 1
            while high < len(keys) and keys[high] == keys[low]:
                high += 1
            if keys[low][:2] != block:
                if block:
                    yield from _block_pairs(head, rows, block[0])
                block, head, rows = keys[low][:2], [], []
            part = batch.slice(low, high - low)
            if keys[low][2] == 0:
                head += zip(*[part.column(i).to_pylist() for i in (3, 4, 5)])
            else:
                rows.append(part.select(["terms", "counts"]))
            low = high
    if block:
        yield from _block_pairs(head, rows, block[0])


def pair_rows(words: DataFrame, sizes: DataFrame) -> DataFrame:
    """Each group against every other source of its language, over all kept terms."""
    blocks = (F.floor((F.col("n_terms") - 1) / BLOCK_TERMS) + 1).cast("int")
    of_lang = sizes.groupBy("lang").agg(F.greatest(F.max(blocks), F.lit(1)).alias("blocks"))
    none = F.lit(None)
    rows = words.groupBy("lang", "counts").agg(F.count("*").alias("terms")).join(of_lang, "lang").select(
        "lang", F.pmod(F.xxhash64("counts"), F.col("blocks")).cast("int").alias("block"), F.lit(1).alias("kind"), none.cast("string").alias("source"),
        none.cast("long").alias("n_group"), none.cast("long").alias("n_terms"), "terms", "counts")
    heads = sizes.join(of_lang, "lang").select(
        "lang", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(0).alias("kind"), "source", "n_group", "n_terms",
        none.cast("long").alias("terms"), none.cast(words.schema["counts"].dataType).alias("counts"))
    blocked = heads.unionByName(rows).repartition("lang", "block").sortWithinPartitions("lang", "block", "kind", "source", "counts")
    values = blocked.mapInArrow(_pairs, PAIRS).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item")))
    return values.select("lang", "source", F.lit("pair").alias("part"), "item", "value", rank.alias("rank"))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank: distances of sources, and the terms that set a source apart."""
    words = settled(vocabulary(docs, min_docs))
    sizes = settled(_sizes(docs, words))
    return pair_rows(words, sizes).unionByName(term_rows(words, sizes, top)).withColumn("rank", F.col("rank").cast("int"))
