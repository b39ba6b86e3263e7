"""Near-duplicate embeddings by a forest of random-projection trees with overlap.

1. Equal vectors are folded into one representative with a count.
2. The upper levels of every tree are fitted on a bounded sample: random
   directions, split at the sample's median; vectors near a split go to both sides.
3. All representatives are routed to the cells of every tree. In its own task,
   a cell is split on in the same way down to small leaves.
4. Vectors are compared within leaves. Each leaf keeps a star for every group of
   its linked vectors; their union over all trees gives the components.
5. All links lie inside components. There they are counted exactly, component
   by component, large ones in blocks, without writing pairs.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isohyet.llm.components import components
from isohyet.llm.texts import settled

TREES = 10
LEAF = 400
# Overlap at a split, as a part of the length that a just linked pair's difference has in one direction.
OVERLAP = 0.35
# But never more than this share of the vectors on either side, so that every split shrinks.
MOST_OVERLAP = 0.15
SAMPLE = 65_536  # vectors that come to the driver to fit the upper levels
LEAST_SAMPLE = 64  # sampled vectors of a cell
CELL_ROWS = 8_192
BLOCK = 1_024
# Cosines this close to the threshold are decided exactly.
TIE = 1e-9


def direction(tree: int, node: int, dim: int) -> np.ndarray:
    v = np.random.default_rng((tree, node, dim)).standard_normal(dim)
    return v / np.linalg.norm(v)


def split(place: np.ndarray, margin: float) -> tuple[float, float]:
    """(low, high): the left side takes places up to `high`, the right side those from `low` on."""
    below, middle, above = np.quantile(place, (0.5 - MOST_OVERLAP, 0.5, 0.5 + MOST_OVERLAP))
    return max(middle - margin, below), min(middle + margin, above)


def margin_of(threshold: float, dim: int) -> float:
    return OVERLAP * float(np.sqrt(2 * (1 - threshold) / dim))


def numbers(raw: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(raw), "<f8").reshape(len(raw), -1)


def near_pairs(unit_a: np.ndarray, unit_b: np.ndarray, raw_a: np.ndarray, raw_b: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs have a cosine of at least the threshold.

    A product of unit vectors may miss the threshold by rounding, and by another amount in a matrix
    of another shape. Pairs that close are decided exactly, from their own numbers:
    dot > 0 and dot^2 >= threshold^2 * |a|^2 * |b|^2 in rational arithmetic.
    """
    cosine = unit_a @ unit_b.T
    near = cosine >= threshold
    for i, j in zip(*np.nonzero(np.abs(cosine - threshold) < TIE)):
        near[i, j] = reaches(raw_a[i], raw_b[j], threshold)
    return near


def reaches(a: np.ndarray, b: np.ndarray, threshold: float) -> bool:
    x, y = [Fraction(v) for v in a.tolist()], [Fraction(v) for v in b.tolist()]
    dot, limit = sum(p * q for p, q in zip(x, y)), Fraction(repr(threshold))
    return dot > 0 and dot * dot >= limit * limit * sum(p * p for p in x) * sum(q * q for q in y)


def unit(raw: list[bytes]) -> np.ndarray:
    x = numbers(raw)
    # Scaled first: squares of very small or large values would leave the range of doubles.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def fit_upper(vectors: np.ndarray, total: int, trees: int, threshold: float) -> list[dict[int, tuple[float, float]]]:
    """Per tree, node number -> (low, high). Node k has the children 2k and 2k + 1; the root is 1."""
    margin = margin_of(threshold, vectors.shape[1])
    out = []
    for tree in range(trees):
        nodes, open_ = {}, [(1, np.arange(len(vectors)))]
        while open_:
            node, rows = open_.pop()
            if len(rows) * total / len(vectors) <= CELL_ROWS or len(rows) < 2 * LEAST_SAMPLE:
                continue
            place = vectors[rows] @ direction(tree, node, vectors.shape[1])
            low, high = nodes[node] = split(place, margin)
            left, right = rows[place <= high], rows[place >= low]
            if len(left) == len(rows) or len(right) == len(rows):
                del nodes[node]  # equal places: no split parts them
                continue
            open_ += [(2 * node, left), (2 * node + 1, right)]
        out.append(nodes)
    return out


def route(vectors: np.ndarray, nodes: dict[int, tuple[float, float]], tree: int):
    """(cell, rows) of every cell that takes some of the vectors."""
    open_ = [(1, np.arange(len(vectors)))]
    while open_:
        node, rows = open_.pop()
        if node not in nodes:
            yield node, rows
            continue
        low, high = nodes[node]
        place = vectors[rows] @ direction(tree, node, vectors.shape[1])
        for child, part in ((2 * node, rows[place <= high]), (2 * node + 1, rows[place >= low])):
            if len(part):
                open_.append((child, part))


def leaf_stars(vectors: np.ndarray, raw: np.ndarray, ids: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Verified links of a leaf, as stars around the smallest id of each linked group."""
    label, found = ids.copy(), {}
    while True:
        new = label.copy()
        for low in range(0, len(ids), BLOCK):
            near = found.get(low)
            if near is None:
                near = near_pairs(vectors[low:low + BLOCK], vectors, raw[low:low + BLOCK], raw, threshold)
                np.fill_diagonal(near[:, low:], True)
                if len(ids) <= CELL_ROWS:  # one bit a byte; larger leaves are compared anew
                    found[low] = near
            new[low:low + BLOCK] = np.where(near, label[None, :], np.iinfo(np.int64).max).min(axis=1)
        if (new == label).all():
            break
        label = new
    apart = label != ids
    return ids[apart], label[apart]


def cell_stars(vectors: np.ndarray, raw: np.ndarray, ids: np.ndarray, tree: int, node: int, threshold: float):
    """Split a cell on to leaves and compare within each."""
    margin = margin_of(threshold, vectors.shape[1])
    open_ = [(node, np.arange(len(ids)))]
    while open_:
        node, rows = open_.pop()
        if len(rows) > LEAF:
            place = vectors[rows] @ direction(tree, node, vectors.shape[1])
            low, high = split(place, margin)
            left, right = rows[place <= high], rows[place >= low]
            if max(len(left), len(right)) < len(rows):
                open_ += [(2 * node, left), (2 * node + 1, right)]
                continue
        if len(rows) > 1:
            yield leaf_stars(vectors[rows], raw[rows], ids[rows], threshold)


def usable_vectors(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id and vector (doubles) of the rows that can link with others."""
    value = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), value.alias("vector"))
    return rows.filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & (F.size("vector") > 0)).filter(
        finite & F.exists("vector", lambda x: x != 0))


def _packed(batch_vectors: pa.Array) -> list[bytes]:
    """Each row's doubles as bytes."""
    flat, starts = batch_vectors.flatten().to_numpy(zero_copy_only=False).astype("<f8"), batch_vectors.offsets.to_numpy()
    starts = starts - starts[0]
    data = flat.tobytes()
    return [data[8 * a:8 * b] for a, b in zip(starts, starts[1:])]


def near_duplicates(table: DataFrame, threshold: float = 0.9, trees: int = TREES, id_col: str = "vec_id",
                    vector_col: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id, kept for every row.

    Vectors are linked when their cosine is at least `threshold`; ties are decided exactly. Null, empty and
    zero vectors, those with null or non-finite components, and rows with a null
    id are linked with nothing; vectors of different lengths are never linked.
    Rows that repeat an id with the same vector are linked with each other.
    """
    spark = table.sparkSession
    usable = usable_vectors(table, id_col, vector_col)
    folded = usable.groupBy("vector").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n"))
    reps = settled(folded.withColumn("dim", F.size("vector")))
    stars = spark.createDataFrame([], "a long, b long")
    dims = [(r["dim"], r["count"]) for r in reps.groupBy("dim").count().collect()]
    for dim, total in dims:
        own = reps.filter(F.col("dim") == dim)
        stars = stars.union(_forest(own, total, trees, threshold))
    joined = components(stars)
    counted = _count_links(reps, joined, threshold)
    places = reps.join(joined.withColumnRenamed("id", "rep"), "rep", "left").join(counted, "rep", "left").select(
        "vector", F.coalesce("component", "rep").alias("component_id"),
        (F.coalesce("linked", F.lit(0)) + F.col("n") - 1).alias("n_links"))
    found = usable.join(places, "vector").select("vec_id", "n_links", "component_id").dropDuplicates(["vec_id"])
    return table.select(F.col(id_col).cast("long").alias("vec_id")).join(found, "vec_id", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def _forest(reps: DataFrame, total: int, trees: int, threshold: float) -> DataFrame:
    spark = reps.sparkSession
    chosen = reps
    if total > SAMPLE:  # a hash picks the sample; a little less than its bound is asked for
        chosen = reps.filter(F.pmod(F.xxhash64("rep"), F.lit(1 << 30)) < int(0.97 * SAMPLE / total * (1 << 30)))
    sample = unit(_packed(chosen.select("vector").toArrow().column(0).combine_chunks()))
    upper = spark.sparkContext.broadcast(fit_upper(sample, total, trees, threshold))

    def assign(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            packed = _packed(batch.column("vector"))
            vectors, data, ids = unit(packed), pa.array(packed, pa.binary()), batch.column("rep")
            for tree, nodes in enumerate(upper.value):
                for cell, rows in route(vectors, nodes, tree):
                    take = pa.array(rows)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(rows), tree), pa.int32()), pa.array(np.full(len(rows), cell), pa.int64()),
                         ids.take(take), data.take(take)], names=["tree", "cell", "rep", "data"])

    def compare(cell: pa.Table) -> pa.Table:
        a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        data, ids = cell.column("data").to_pylist(), cell.column("rep").to_numpy().astype(np.int64)
        for x, y in cell_stars(unit(data), numbers(data), ids, cell.column("tree")[0].as_py(), cell.column("cell")[0].as_py(), threshold):
            a.append(x), b.append(y)
        return pa.table({"a": np.concatenate(a), "b": np.concatenate(b)})

    cells = reps.select("rep", "vector").mapInArrow(assign, "tree int, cell long, rep long, data binary")
    return cells.groupBy("tree", "cell").applyInArrow(compare, "a long, b long").distinct()


def _count_links(reps: DataFrame, joined: DataFrame, threshold: float) -> DataFrame:
    """rep, linked: the vectors linked with each representative, copies counted, itself and its own copies not."""
    placed = reps.select("rep", "n", "vector").join(joined.withColumnRenamed("id", "rep"), "rep")
    blocks = joined.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    own = F.pmod(F.xxhash64("rep"), "blocks")
    dealt = placed.join(blocks, "component").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    # Small components share a group by a hash; each block pair of a large one is a group.
    dealt = dealt.select("rep", "n", "vector", "component", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                         F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("component"), F.lit(512))).otherwise(F.col("component") + 512).alias("part"))

    def count(group: pa.Table) -> pa.Table:
        group = group.sort_by("component")
        ids, n = group.column("rep").to_numpy(), group.column("n").to_numpy()
        own, i, j = (group.column(c).to_numpy() for c in ("own", "i", "j"))
        component = group.column("component").to_numpy()
        packed = _packed(group.column("vector").combine_chunks())
        linked = np.zeros(len(ids), np.int64)
        cuts = np.r_[0, np.flatnonzero(np.diff(component)) + 1, len(ids)]
        for low, high in zip(cuts, cuts[1:]):
            x, raw, rows = unit(packed[low:high]), numbers(packed[low:high]), np.arange(low, high)
            first, second = rows[own[low:high] == i[low]], rows[own[low:high] == j[low]]
            near = near_pairs(x[first - low], x[second - low], raw[first - low], raw[second - low], threshold)
            if i[low] == j[low]:
                np.fill_diagonal(near, False)
                linked[first] = near @ n[second]
            else:
                linked[first] = near @ n[second]
                linked[second] = near.T @ n[first]
        return pa.table({"rep": ids, "linked": linked})

    counts = dealt.groupBy("part", "i", "j").applyInArrow(count, "rep long, linked long")
    return counts.groupBy("rep").agg(F.sum("linked").alias("linked"))
