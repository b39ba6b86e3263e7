"""Exact repeated passages by hash-compared suffix sorting.

A string of `length` bytes that occurs twice has the same anchor in both places:
the leftmost place of the smallest hash among its runs of ANCHOR_BYTES bytes.

1. Every document is cut into regions, one per anchor: all strings that have it.
   Only hashes of anchors and regions are shuffled.
2. Equal regions are repeated as a whole and folded, before the shuffle. An
   anchor with one region needs no more work.
3. For anchors with several different regions, the regions' bytes are gathered.
   What follows the anchor and, backwards, what precedes it are suffix-sorted.
   Strings with the same distance to the anchor are equal when they lie in one
   interval of common extensions in both orders.
4. The repeated strings go back to their documents, whose bytes are marked.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isohyet.llm.suffix_sort import Hashes, suffix_sort
from isohyet.llm.texts import chunks, map_texts, settled

ANCHOR_BYTES = 40
# Regions sorted at a time by a task, whole groups together; characters hashed at a time.
BATCH_REGIONS = 3_000
HASHED_CHARS = 300_000
SIZE_BITS = 8
PLACE_MASK = (1 << 32) - 1


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return x ^ (x >> np.uint64(27))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each `width` neighbours, by doubling."""
    span = 1
    while 2 * span <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[:len(x) - (width - span)], x[width - span:]) if span < width else x


def regions_of(raw: np.ndarray, starts: np.ndarray, sizes: np.ndarray, length: int):
    """(document, first string, strings, anchor, anchor hash, region hash) of every region of a batch of documents."""
    none = np.empty(0, np.int64)
    if len(raw) < length or not (sizes >= length).any():
        return none, none, none, none, none, none
    hashes = Hashes(raw)
    grams = mixed(hashes.of(np.arange(len(raw) - ANCHOR_BYTES + 1), ANCHOR_BYTES))
    # The place in the low bits makes the leftmost of equal (upper halves of) hashes the smallest. Their number is
    # fixed: a string's anchor must not depend on how much text lies around it.
    mask = np.uint64(PLACE_MASK)
    if len(raw) > PLACE_MASK:
        raise ValueError("a batch of texts must be shorter than 4 GB")
    anchor = (sliding_min((grams & ~mask) | np.arange(len(grams), dtype=np.uint64), length - ANCHOR_BYTES + 1) & mask).astype(np.int64)
    long = np.flatnonzero(sizes >= length)
    change = np.zeros(len(raw) + 1, np.int64)
    np.add.at(change, starts[long], 1)
    np.add.at(change, starts[long] + sizes[long] - length + 1, -1)
    place = np.flatnonzero(np.cumsum(change[:-1]) > 0)
    anchor = anchor[place]
    new = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
    low, count = place[new], np.diff(np.r_[new, len(place)])
    whole = hashes.of(low, count - 1 + length)
    doc = np.searchsorted(starts, low, side="right") - 1
    # Empty documents share their start with the next one; the last of them is meant.
    return (doc, low - starts[doc], count, anchor[new] - low, grams[anchor[new]].view(np.int64),
            mixed(whole + count.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64))


def flat(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    coded = [t.encode("utf-8", "surrogatepass") for t in texts]
    sizes = np.fromiter(map(len, coded), np.int64, len(coded))
    return np.frombuffer(b"".join(coded), np.uint8), np.cumsum(sizes) - sizes, sizes


def repeated_strings(raw: np.ndarray, start: np.ndarray, size: np.ndarray, before: np.ndarray, count: np.ndarray,
                     copies: np.ndarray, group: np.ndarray, length: int) -> np.ndarray:
    """Which strings of each region are repeated: a boolean row per region, a column per string.

    Regions of one group (sorted) share an anchor, `before` bytes after their start.
    """
    n = len(start)
    out = np.zeros((n, length - ANCHOR_BYTES + 1), bool)
    anchor = start + before
    right, right_common = suffix_sort(raw, anchor, size - before, group)
    left, left_common = suffix_sort(raw[::-1], len(raw) - anchor, before, group)
    right_id, left_id = np.empty(n, np.int64), np.empty(n, np.int64)
    for distance in range(int(before.max(initial=0)) + 1):
        rows = np.flatnonzero((distance <= before) & (distance > before - count))
        if len(rows) < 2:
            continue
        right_id[right] = np.cumsum(right_common < length - distance)
        left_id[left] = np.cumsum(left_common < distance)
        key = right_id[rows] * (n + 1) + left_id[rows]
        _, which, times = np.unique(key, return_inverse=True, return_counts=True)
        again = rows[times[which] > 1]
        out[again, before[again] - distance] = True
    out[copies > 1] = True
    return out


def _sort_regions(length: int):
    """Rows sorted by anchor: whole groups are gathered, solved and given back with the repeated strings as bits."""
    def solve(rows: list[dict]) -> pa.RecordBatch:
        data = [r["bytes"] for r in rows]
        size = np.fromiter(map(len, data), np.int64, len(data))
        before, count, copies = (np.array([r[c] for r in rows], np.int64) for c in ("before", "strings", "copies"))
        group = np.array([r["anchor"] for r in rows], np.int64)
        found = repeated_strings(np.frombuffer(b"".join(data), np.uint8), np.cumsum(size) - size, size, before, count, copies, group, length)
        return pa.RecordBatch.from_arrays([
            pa.array([r["anchor"] for r in rows], pa.int64()), pa.array([r["region"] for r in rows], pa.int64()),
            pa.array([np.packbits(f).tobytes() for f in found], pa.binary())], names=["anchor", "region", "bits"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            for low in range(0, batch.num_rows, BATCH_REGIONS):
                held += batch.slice(low, BATCH_REGIONS).to_pylist()
                # The last group may go on.
                cut = len(held)
                while cut and held[cut - 1]["anchor"] == held[-1]["anchor"]:
                    cut -= 1
                if cut and len(held) >= BATCH_REGIONS:
                    yield solve(held[:cut])
                    held = held[cut:]
        if held:
            yield solve(held)

    return run


def _cut_regions(length: int):
    """Bytes of the regions that a document lends to the sort."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], [], []]
            for text, wanted in zip(batch.column("text").to_pylist(), batch.column("wanted").to_pylist()):
                data = text.encode("utf-8", "surrogatepass")
                for w in wanted:
                    low, count, before = unpack(w["place"])
                    for column, value in zip(out, (w["anchor"], w["region"], w["copies"], before, count,
                                                   data[low:low + count - 1 + length])):
                        column.append(value)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)],
                                             names=["anchor", "region", "copies", "before", "strings", "bytes"])

    return run


def unpack(place: int) -> tuple[int, int, int]:
    """First string, number of strings, bytes before the anchor."""
    size = (1 << SIZE_BITS) - 1
    return place >> 2 * SIZE_BITS, ((place >> SIZE_BITS) & size) + 1, place & size


def removed_bytes(n: int, found: list[dict], length: int) -> np.ndarray:
    """Which of a document's n bytes are covered by repeated strings."""
    change = np.zeros(n + 1, np.int64)
    for f in found:
        low, count, _ = unpack(f["place"])
        if f["bits"] is None:
            again = np.arange(low, low + count)
        else:
            again = low + np.flatnonzero(np.unpackbits(np.frombuffer(f["bits"], np.uint8))[:count])
        np.add.at(change, again, 1)
        np.add.at(change, again + length, -1)
    return np.cumsum(change[:n]) > 0


def repeats(docs: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text",
            keep: tuple[str, ...] = ()) -> DataFrame:
    """_id, doc_id, `_row` (a struct of the columns to keep), text and `found` (the repeated strings of each text), for every row.

    _id is a key of the row, stored with it: ids may repeat or be null.
    """
    if not ANCHOR_BYTES < length <= ANCHOR_BYTES + (1 << SIZE_BITS):
        raise ValueError(f"length must lie between {ANCHOR_BYTES + 1} and {ANCHOR_BYTES + (1 << SIZE_BITS)}")
    rows = settled(docs.select(F.monotonically_increasing_id().alias("_id"), F.col(id_col).cast("long").alias("doc_id"),
                               *[F.struct(*keep).alias("_row")] * bool(keep), F.coalesce(F.col(text_col), F.lit("")).alias("text")))
    texts = rows.select("_id", "text")

    def start():
        def work(ids, texts):
            raw, starts, sizes = flat(texts)
            doc, low, count, before, anchor, region = regions_of(raw, starts, sizes, length)
            place = (low << 2 * SIZE_BITS) | ((count - 1) << SIZE_BITS) | before
            return [np.array(ids, np.int64)[doc], place, anchor, region]

        return work

    all_regions = settled(map_texts(texts, "_id long, place long, anchor long, region long", start, HASHED_CHARS))
    anchors = all_regions.groupBy("anchor").agg(
        F.count(F.lit(1)).alias("rows"), F.min("region").alias("low"), F.max("region").alias("high")).filter("rows > 1")
    shared = settled(all_regions.join(anchors.select("anchor", (F.col("low") < F.col("high")).alias("several")), "anchor"))
    folded = shared.groupBy("anchor", "region", "several").agg(
        F.count(F.lit(1)).alias("copies"), F.min(F.struct("_id", "place")).alias("first"))
    lenders = folded.filter("several").select(
        F.col("first._id").alias("_id"), F.struct(F.col("first.place").alias("place"), "anchor", "region", "copies").alias("w"))
    by_id = rows.repartition("_id")
    # A document lends at most its own regions.
    lent = by_id.join(lenders.groupBy("_id").agg(F.collect_list("w").alias("wanted")), "_id").select("text", "wanted")
    cut = lent.mapInArrow(_cut_regions(length), "anchor long, region long, copies long, before int, strings int, bytes binary")
    cut = cut.repartition("anchor").sortWithinPartitions("anchor", "region")
    solved = settled(cut.mapInArrow(_sort_regions(length), "anchor long, region long, bits binary"))
    whole = folded.filter("not several and copies > 1").select("anchor", "region", F.lit(None).cast("binary").alias("bits"))
    known = solved.filter(F.col("bits") != F.lit(bytes((length - ANCHOR_BYTES + 8) // 8))).union(whole)
    marks = shared.join(known, ["anchor", "region"]).groupBy("_id").agg(F.collect_list(F.struct("place", "bits")).alias("found"))
    return by_id.join(marks, "_id", "left")


def _removed(data: bytes, found: list[dict] | None, length: int) -> np.ndarray:
    return removed_bytes(len(data), found, length) if found else np.zeros(len(data), bool)


def _kept(data: bytes, removed: np.ndarray) -> bytes:
    return np.frombuffer(data, np.uint8)[~removed].tobytes()


def dedup(docs: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the kept text of every row.

    A byte is removed when it is covered by a string of `length` bytes that also
    starts anywhere else in the table, the same document included. A null text
    counts as empty; texts shorter than `length` stay whole. Repeated rows are
    copies of each other and lose all they have. A character of which a part is
    removed is left out of the kept text; the digest is of the bytes.
    """
    def start():
        def work(keys, texts):
            out = []
            for key, text in zip(keys, texts):
                data = text.encode("utf-8", "surrogatepass")
                gone = _removed(data, key["found"], length)
                kept = _kept(data, gone)
                spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
                out.append((key["doc_id"], len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(),
                            kept.decode("utf-8", "ignore")))
            return [list(c) for c in zip(*out)]

        return work

    rows = repeats(docs, length, id_col, text_col).select(F.struct("doc_id", "found").alias("key"), "text")
    return map_texts(rows, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text string", start)


def kept_texts(docs: DataFrame, keep: tuple[str, ...], length: int = 200, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The kept text of every row as dedup() has it, and `_row`, a struct of the columns to keep."""
    @F.arrow_udf("string")
    def kept_of(texts: pa.Array, found: pa.Array) -> pa.Array:
        out = []
        for low, high in chunks(texts):
            for text, own in zip(texts.slice(low, high - low).to_pylist(), found.slice(low, high - low).to_pylist()):
                data = text.encode("utf-8", "surrogatepass")
                out.append(_kept(data, _removed(data, own, length)).decode("utf-8", "ignore"))
        return pa.array(out, pa.string())

    # A deterministic function would be called again for every use of its result.
    kept = kept_of.asNondeterministic()("text", "found")
    return repeats(docs, length, id_col, text_col, keep).select("_row", kept.alias("kept_text"))
