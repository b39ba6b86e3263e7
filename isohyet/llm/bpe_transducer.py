"""BPE encoding and decoding with a minimal acyclic transducer as lexicon.

1. Spark counts the pre-tokens of all texts; the most frequent ones (a stated
   number) form the lexicon.
2. The lexicon is compiled into a minimal acyclic automaton over UTF-8 bytes
   whose states are shared by common suffixes. Arc outputs add up to a word's
   number, which addresses its token ids: the automaton maps words to ids.
3. The compiled arrays are written to the shared folder, handed to the executors
   by Spark, and memory-mapped there.
4. Tasks walk all new words of a chunk through the automaton at once. Words that
   it does not accept are merged exactly, pair by pair.
"""

from __future__ import annotations

import hashlib
import json
import mmap
import unicodedata
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isohyet.llm.ragged_merge import MergeTable
from isohyet.llm.texts import chunks, id_and_text, map_texts, scratch, settled

# Words of the lexicon; the rest of the vocabulary is merged when met.
LEXICON_WORDS = 50_000
REMEMBERED = 800_000
SPACE = regex.compile(r"\p{White_Space}+")


def byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies use for each byte."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(others)) for b in range(256)]


class WordBpe:
    """A byte-level word BPE with an end-of-word mark, read from a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        kinds = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        if model["type"] != "BPE" or kinds != ["NFC", "Replace", "Lowercase"] or not model["end_of_word_suffix"]:
            raise ValueError("not a lower-casing word BPE")
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern = regex.compile(split["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}"))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_split = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        vocab = model["vocab"]
        self.names = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        letters = byte_letters()
        self.inner = np.array([vocab[c] for c in letters], np.int64)
        self.last = np.array([vocab[c + model["end_of_word_suffix"]] for c in letters], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.table = MergeTable([vocab[a] for a, _ in pairs], [vocab[b] for _, b in pairs],
                                [vocab[a + b] for a, b in pairs], range(len(pairs)), max(vocab.values()) + 1)

    def chunks(self, text: str) -> list[str]:
        """Runs without white space; no pre-token crosses them."""
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):  # str.split() takes these as white space
            return [c for c in SPACE.split(text) if c]
        return text.split()

    def words(self, chunk: str) -> list[str]:
        """Pre-tokens of a chunk; special tokens stand as themselves."""
        if "<|" not in chunk:
            return self.pattern.findall(self.normal(chunk))
        out = []
        for part in self.special_split.split(chunk):
            out += [part] if part in self.special else self.pattern.findall(self.normal(part))
        return out

    @staticmethod
    def normal(text: str) -> str:
        text = text if text.isascii() else unicodedata.normalize("NFC", text)
        # Letter by letter where a whole-word rule would differ.
        return "".join(c.lower() for c in text) if "Σ" in text else text.lower()

    def merge(self, words: list[str]) -> list[list[int]]:
        """Exact token ids of words, merged pair by pair."""
        coded = [w.encode() for w in words]
        lengths = np.fromiter(map(len, coded), np.int64, len(coded))
        raw = np.frombuffer(b"".join(coded), np.uint8)
        symbols = self.inner[raw]
        ends = np.cumsum(lengths)[lengths > 0] - 1
        symbols[ends] = self.last[raw[ends]]
        kept, sizes = self.table.merge(symbols, lengths)
        flat, cuts = kept.tolist(), np.r_[0, np.cumsum(sizes)].tolist()
        return [flat[a:b] for a, b in zip(cuts, cuts[1:])]


class Transducer:
    """Minimal acyclic automaton: UTF-8 words -> word numbers -> token ids."""

    FIELDS = ("arc_key", "arc_to", "arc_out", "final", "ids", "id_start")

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.__dict__.update({k: arrays[k] for k in self.FIELDS})

    @classmethod
    def compile(cls, entries: dict[str, list[int]]) -> Transducer:
        """Build from sorted words; finished suffix states are shared as they close."""
        words = sorted(w.encode() for w in entries)
        register: dict[tuple, int] = {}
        states: list[tuple] = []  # per shared state: (final, arcs), arcs are (byte, state)
        path: list[list] = [[False, []]]  # open states of the last word
        last = b""

        def close(depth: int) -> None:
            while len(path) > depth + 1:
                final, arcs = path.pop()
                key = (final, tuple(arcs))
                state = register.get(key)
                if state is None:
                    state = register[key] = len(states)
                    states.append(key)
                path[-1][1][-1] = (path[-1][1][-1][0], state)

        for word in words:
            same = 0
            while same < min(len(word), len(last)) and word[same] == last[same]:
                same += 1
            close(same)
            for byte in word[same:]:
                path[-1][1].append((byte, -1))
                path.append([False, []])
            path[-1][0] = True
            last = word
        close(0)
        root = len(states)
        states.append((path[0][0], tuple(path[0][1])))
        # Words below each state; children close before their parents.
        below = np.zeros(len(states), np.int64)
        keys, to, out = [], [], []
        for s, (final, arcs) in enumerate(states):
            number = int(final)
            for byte, child in arcs:
                keys.append(s * 256 + byte), to.append(child), out.append(number)
                number += int(below[child])
            below[s] = number
        ids = [entries[w.decode()] for w in words]
        return cls({
            "arc_key": np.array(keys, np.int64), "arc_to": np.array(to, np.int64), "arc_out": np.array(out, np.int64),
            "final": np.array([f for f, _ in states], np.int64),
            "ids": np.array([i for x in ids for i in x], np.int64),
            "id_start": np.cumsum([0, *map(len, ids)]).astype(np.int64),
        }) if root == len(states) - 1 else None

    def to_bytes(self) -> bytes:
        arrays = [np.ascontiguousarray(getattr(self, f), np.int64) for f in self.FIELDS]
        return np.array([len(a) for a in arrays], np.int64).tobytes() + b"".join(a.tobytes() for a in arrays)

    @classmethod
    def mapped(cls, path: str) -> Transducer:
        """Memory-map a compiled file; processes of one machine share its pages."""
        with open(path, "rb") as f:
            view = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        sizes = np.frombuffer(view, np.int64, len(cls.FIELDS))
        at, arrays = 8 * len(cls.FIELDS), {}
        for field, n in zip(cls.FIELDS, sizes.tolist()):
            arrays[field] = np.frombuffer(view, np.int64, n, at)
            at += 8 * n
        return cls(arrays)

    def look_up(self, words: list[str]) -> np.ndarray:
        """Word numbers, -1 where a word is not accepted; all words step together."""
        number = np.full(len(words), -1, np.int64)
        if not len(self.arc_key) or not words:
            return number
        coded = [w.encode() for w in words]
        lengths = np.fromiter(map(len, coded), np.int64, len(coded))
        raw = np.frombuffer(b"".join(coded), np.uint8)
        start = np.cumsum(lengths) - lengths
        alive = np.flatnonzero(lengths > 0)
        state = np.full(len(alive), len(self.final) - 1, np.int64)
        total = np.zeros(len(alive), np.int64)
        step = 0
        while len(alive):
            key = state * 256 + raw[start[alive] + step]
            at = np.minimum(np.searchsorted(self.arc_key, key), len(self.arc_key) - 1)
            ok = self.arc_key[at] == key
            alive, at, total = alive[ok], at[ok], total[ok]
            state, total = self.arc_to[at], total + self.arc_out[at]
            step += 1
            ended = lengths[alive] == step
            accepted = ended & (self.final[state] == 1)
            number[alive[accepted]] = total[accepted]
            alive, state, total = alive[~ended], state[~ended], total[~ended]
        return number

    def ids_of(self, number: int) -> list[int]:
        return self.ids[self.id_start[number]:self.id_start[number + 1]].tolist()


class Encoder:
    """Encodes and decodes chunk by chunk; results of chunks are remembered."""

    def __init__(self, bpe: WordBpe, lexicon: Transducer | None):
        self.bpe, self.lexicon = bpe, lexicon
        self.seen: dict[str, tuple[list[int], int, str, str]] = {}

    def encode_words(self, words: list[str]) -> list[list[int]]:
        number = self.lexicon.look_up(words) if self.lexicon else np.full(len(words), -1)
        unseen = [w for w, k in zip(words, number) if k < 0]
        merged = iter(self.bpe.merge(unseen))
        return [next(merged) if k < 0 else self.lexicon.ids_of(k) for k in number.tolist()]

    def learn(self, chunks: set[str]) -> None:
        cut = {c: self.bpe.words(c) for c in chunks}
        words = list(set().union(*cut.values()).difference(self.bpe.special))
        ids_of = dict(zip(words, self.encode_words(words))) | {s: [i] for s, i in self.bpe.special.items()}
        names = self.bpe.names
        for chunk, parts in cut.items():
            ids = [i for w in parts for i in ids_of[w]]
            self.seen[chunk] = (len(ids), " ".join(map(str, ids)), " ".join([names[i] for i in ids]))

    def encode(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """Per text: number of tokens, decimal ids joined by a space, decoded text."""
        cut = [self.bpe.chunks(t) for t in texts]
        new = set().union(*cut).difference(self.seen)
        if new:
            if len(self.seen) > REMEMBERED:
                self.seen.clear()
                new = set().union(*cut)
            self.learn(new)
        out = []
        for chunks in cut:
            # Chunks such as a lone special form always have tokens, so no empty parts are joined.
            got = [self.seen[c] for c in chunks]
            out.append((sum(g[0] for g in got), " ".join([g[1] for g in got if g[0]]), " ".join([g[2] for g in got if g[0]])))
        return out


def word_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, n: how often each pre-token occurs in all texts.

    Each task counts the runs between white space, cuts every distinct run once,
    and gives the sums to the shuffle; its memory is emptied when it is full.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, runs = WordBpe(path), Counter()

        def flush() -> pa.RecordBatch:
            words = Counter()
            for c, n in runs.items():
                for w in bpe.words(c):
                    words[w] += n
            runs.clear()
            for s in bpe.special:
                words.pop(s, None)
            return pa.RecordBatch.from_arrays([pa.array(list(words), pa.string()), pa.array(list(words.values()), pa.int64())],
                                              names=["word", "n"])

        for batch in batches:
            texts = batch.column(1)
            for low, high in chunks(texts):
                for t in texts.slice(low, high - low).to_pylist():
                    runs.update(bpe.chunks(t))
                if len(runs) > REMEMBERED:
                    yield flush()
        yield flush()

    counted = id_and_text(docs, id_col, text_col).mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def build_lexicon(docs: DataFrame, path: str, max_words: int = LEXICON_WORDS,
                  id_col: str = "doc_id", text_col: str = "text") -> Transducer:
    """Compile the most frequent pre-tokens of all texts, at most `max_words`; only these come to the driver.

    The counts of counts give the frequency from which on all words fit.
    """
    counts = settled(word_counts(docs, path, id_col, text_col).filter("n > 1"))
    # At most as many rows as there are different frequencies; the largest ones fill the lexicon.
    sizes = counts.groupBy("n").agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("n")).limit(max_words).collect()
    least, total = None, 0
    for row in sizes:
        total += row["words"]
        if total > max_words:
            break
        least = row["n"]
    words = [] if least is None else [r[0] for r in counts.filter(F.col("n") >= least).select("word").collect()]
    return Transducer.compile(dict(zip(words, WordBpe(path).merge(words))))


def share(spark, lexicon: Transducer) -> str:
    """Store a compiled lexicon in the shared folder and have Spark hand it to all executors."""
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    uri = f"{scratch(spark)}/{name}"
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(uri)
    stream = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target)
    try:
        stream.write(bytearray(lexicon.to_bytes()))
    finally:
        stream.close()
    spark.sparkContext.addFile(uri)
    return name


def encode(docs: DataFrame, path: str, max_words: int = LEXICON_WORDS, with_ids: bool = False,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 for every row; `with_ids` adds the ids and the decoded text.

    A null text counts as empty: no tokens, digests of the empty text. Repeated
    rows give repeated results, a null id stays null, other columns are left out.
    """
    name = share(docs.sparkSession, build_lexicon(docs, path, max_words, id_col, text_col))

    def start():
        encoder = Encoder(WordBpe(path), Transducer.mapped(SparkFiles.get(name)))

        def digest(text: str) -> str:
            return hashlib.sha256(text.encode()).hexdigest()

        def work(ids, texts):
            got = encoder.encode(texts)
            out = [ids, [g[0] for g in got], [digest(g[1]) for g in got], [digest(g[2]) for g in got]]
            return out + [[[int(i) for i in g[1].split()] for g in got], [g[2] for g in got]] if with_ids else out

        return work

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_texts(id_and_text(docs, id_col, text_col),
                     schema + (", ids array<int>, decoded string" if with_ids else ""), start)
