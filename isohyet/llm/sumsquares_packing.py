"""Sum-of-squares packing of token sequences.

Each document is placed where the sum over all gaps of (open bins with that
gap) squared becomes smallest. Only the number of open bins per gap matters for
the choice, so a placement costs one pass over the possible gaps.

Documents are tokenised in the tasks. Their pieces (a few numbers each) are
stored, dealt by a hash of their place into shards of a bounded size, and each
shard is packed in its own task, longest first. A new sequence is opened only
when no open one has room. A shard ends about one sequence above the least
possible number, so more shards cost next to nothing.
"""

from __future__ import annotations

import json
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isohyet.llm.bpe_transducer import byte_letters
from isohyet.llm.texts import arrow_schema, id_and_text, map_texts, settled

# Pieces of a shard; one task packs a shard in some seconds.
SHARD_PIECES = 40_000
REMEMBERED = 800_000
WHITE = [chr(c) for c in range(0x3001) if chr(c).isspace()]
# Fixed value: the pre-token pattern of byte-level tokenizer files.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def touching(text: str) -> bool:
    """Whether a space stands at an end or next to other white space.

    Only there a pre-token depends on what is on the other side of a single space.
    """
    return text[:1] == " " or text[-1:] == " " or any(
        w in text and (w + " " in text or " " + w in text) for w in WHITE)


def ids_are_ranks(spec: dict) -> bool:
    """Whether a tokenizer file is plain byte-level BPE whose ids stand in the order of its merges, cut by the usual pattern."""
    model, cut = spec["model"], spec.get("pre_tokenizer") or {}
    plain = model.get("type") == "BPE" and not any(model.get(k) for k in (
        "dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
    usual = cut.get("type") == "ByteLevel" and not cut.get("add_prefix_space") and cut.get("use_regex", True) and not spec.get("normalizer")
    if not (plain and usual):
        return False
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    ids = [model["vocab"].get(a + b, -1) for a, b in pairs]
    return all(b > a for a, b in zip(ids, ids[1:])) and -1 not in ids


class ByteBpe:
    """Token ids of a byte-level BPE tokenizer file, remembered by runs between single spaces.

    Where the file's ids are its merge ranks, which is checked, the faster rank-based library gives
    the same ids for plain text; texts with special tokens, and all texts of other files, go to the file's own.
    """

    def __init__(self, path: str, end_id: int):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.plain = None
        self.end = np.array([end_id], "<u4").tobytes()
        self.seen: dict[str, bytes] = {}
        if not ids_are_ranks(json.loads(self.tokenizer.to_str())):
            return
        byte = {c: b for b, c in enumerate(byte_letters())}
        ranks = {bytes(map(byte.__getitem__, t)): i for t, i in self.tokenizer.get_vocab(with_added_tokens=False).items()
                 if t not in self.specials}
        self.plain = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _ids(self, text: str) -> bytes:
        if self.plain is None or any(s in text for s in self.specials):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        ids = self.plain.encode_ordinary(text)
        return array("I", ids).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text, with the end id."""
        # Other files may join what stands on both sides of a space.
        cut = [None if self.plain is None or touching(t) else self._runs(t) for t in texts]
        new = set().union(*[c for c in cut if c]).difference(self.seen)
        if new:
            if len(self.seen) > REMEMBERED:
                self.seen.clear()
                new = set().union(*[c for c in cut if c])
            self.seen.update((r, self._ids(r)) for r in new)
        return [(self._ids(t) if c is None else b"".join(map(self.seen.__getitem__, c))) + self.end
                for t, c in zip(texts, cut)]

    @staticmethod
    def _runs(text: str) -> list[str]:
        if not text:
            return []
        first, *rest = text.split(" ")
        return [first, *[" " + r for r in rest]]


def pieces(docs: DataFrame, path: str, capacity: int = 1024, end_id: int = 2,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: the pieces of every document, the shorter one first."""
    width = 4

    def start():
        bpe = ByteBpe(path, end_id)

        def work(ids, texts):
            out = [[], [], [], [], []]
            for doc, data in zip(ids, bpe.encode(texts)):
                n = len(data) // width
                low, k = 0, 0
                while low < n:
                    high = low + ((n - low) % capacity or capacity)
                    row = (doc, k, low, high - low, zlib.crc32(data[low * width:high * width]))
                    for column, value in zip(out, row):
                        column.append(value)
                    low, k = high, k + 1
            return out

        return work

    return map_texts(id_and_text(docs, id_col, text_col),
                     "doc_id long, piece int, start long, length long, ids_crc32 long", start)


def pack(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sum-of-squares packing in decreasing order: bin and offset of each item."""
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]  # by gap
    count = np.zeros(capacity + 1, np.int64)
    made, none = 0, np.iinfo(np.int64).max
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        # Change of the sum when an open bin with gap g >= n takes the item: one
        # bin less at g, one more at g - n. A bin without a gap counts nothing.
        now = count[n:]
        change = 1 - 2 * now
        change[1:] += 1 + 2 * count[1:capacity + 1 - n]
        change[now == 0] = none
        gap = int(np.argmin(change)) + n
        if count[gap]:
            b = open_bins[gap].pop()
            count[gap] -= 1
        else:
            b, gap = made, capacity
            made += 1
        bins[i], offsets[i] = b, capacity - gap
        if gap - n:
            open_bins[gap - n].append(b)
            count[gap - n] += 1
    return bins, offsets


def pack_pieces(table: DataFrame, capacity: int = 1024, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """Add sequence_id and offset to a table that has a `length` from 1 to `capacity` per row.

    Rows are dealt to shards by their place in the stored table, so a repeated
    row or a hot length spreads like any other.
    """
    table = settled(table)
    shards = max(1, -(-table.count() // shard_pieces))
    dealt = table.withColumn("_shard", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)))
    columns = T.StructType([*table.schema.fields, T.StructField("sequence_id", T.LongType()),
                            T.StructField("offset", T.LongType())])
    schema = arrow_schema(columns)

    def run(shard: pa.Table) -> pa.Table:
        bins, offsets = pack(shard.column("length").to_numpy(), capacity)
        base = shard.column("_shard")[0].as_py() << 32
        out = [shard.column(c).combine_chunks() for c in table_columns]
        return pa.Table.from_arrays([*out, pa.array(bins + base), pa.array(offsets)], schema=schema)

    table_columns = table.columns
    return dealt.groupBy("_shard").applyInArrow(run, columns)


def pack_documents(docs: DataFrame, path: str, capacity: int = 1024, end_id: int = 2, shard_pieces: int = SHARD_PIECES,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: every piece with its place.

    A null text counts as empty and gives one piece that holds the end id. Rows
    with the same or a null id are documents of their own; other columns are left out.
    """
    return pack_pieces(pieces(docs, path, capacity, end_id, id_col, text_col), capacity, shard_pieces)
