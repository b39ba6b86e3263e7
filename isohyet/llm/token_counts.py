"""Token counts by rank-synchronous array merging.

Texts are cut into pre-tokens at the piece model's word marks. Each distinct
pre-token of a chunk is merged once: all of them lie in ragged numpy arrays in
which every sequence applies its lowest-ranked pair at the same time, and the
surviving symbols are counted. No rows are shuffled.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame

from isohyet.llm.ragged_merge import MergeTable
from isohyet.llm.texts import id_and_text, map_texts

MARK = "▁"
PRE_TOKEN = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
# Remembered pre-tokens per task; beyond it the memory starts again.
REMEMBERED = 800_000


class PieceCounter:
    """Counts the tokens of a BPE piece model with byte fallback and no normalisation."""

    def __init__(self, model_path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        size = model.vocab_size()
        pieces = {}
        for i in range(size):
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)):
                pieces[model.id_to_piece(i)] = i
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces):
            raise ValueError("pieces that cross a word mark are not supported")
        for probe in ("a  b", " a ", "Å ﬁ　x\n", "a"):
            if model.normalize(probe) != self.marked(probe):
                raise ValueError("piece models that normalise texts are not supported")
        # Characters that stand only inside longer pieces also need a symbol.
        chars = sorted({c for p in pieces for c in p})
        ids = dict(pieces)
        for c in chars:
            ids.setdefault(c, size + len(ids))
        top = max(ids.values(), default=0) + 1
        left, right, merged, rank = [], [], [], []
        for piece, i in pieces.items():
            order = int(-model.get_score(i))
            for cut in range(1, len(piece)):
                a, b = ids.get(piece[:cut]), ids.get(piece[cut:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), merged.append(i), rank.append(order)
        self.table = MergeTable(left, right, merged, rank, top)
        self.char_codes = np.array([ord(c) for c in chars], np.int64)
        self.char_symbols = np.array([ids[c] for c in chars], np.int64)
        self.n_pieces = size
        self.costs = np.ones(top, np.int64)  # tokens that a surviving symbol stands for
        for c in chars:
            if c not in pieces:
                self.costs[ids[c]] = len(c.encode())
        self.seen: dict[str, int] = {}

    @staticmethod
    def marked(text: str) -> str:
        return MARK + text.replace(" ", MARK) if text else ""

    def count_new(self, tokens: list[str]) -> np.ndarray:
        """Number of tokens of each pre-token, by array merging."""
        lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
        codes = np.frombuffer("".join(tokens).encode("utf-32-le"), np.uint32).astype(np.int64)
        at = np.minimum(np.searchsorted(self.char_codes, codes), len(self.char_codes) - 1)
        known = self.char_codes[at] == codes
        symbols = np.where(known, self.char_symbols[at], -1)
        owner = np.repeat(np.arange(len(tokens)), lengths)
        # A character outside the vocabulary becomes one token per byte.
        n_bytes = 1 + (codes > 0x7F) + (codes > 0x7FF) + (codes > 0xFFFF)
        total = np.bincount(owner[~known], weights=n_bytes[~known], minlength=len(tokens)).astype(np.int64)
        kept, sizes = self.table.merge(symbols, lengths)
        real = kept >= 0
        owner = np.repeat(np.arange(len(tokens)), sizes)
        return total + np.bincount(
            owner[real], weights=self.costs[kept[real]], minlength=len(tokens)).astype(np.int64)

    def counts(self, texts: list[str]) -> list[int]:
        cut = [PRE_TOKEN.findall(self.marked(t)) for t in texts]
        new = set().union(*cut).difference(self.seen)
        if new:
            if len(self.seen) > REMEMBERED:
                self.seen.clear()
                new = set().union(*cut)
            new = list(new)
            self.seen.update(zip(new, self.count_new(new).tolist()))
        return [sum(map(self.seen.__getitem__, tokens)) for tokens in cut]


def token_counts(docs: DataFrame, model_path: str, max_tokens: int = 4096,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row.

    A null text counts as empty: 0 bytes and 0 tokens. Repeated rows give
    repeated results, a null id stays null, other columns are left out.
    """
    def start():
        counter = PieceCounter(model_path)

        def work(ids, texts):
            n = counter.counts(texts)
            return [ids, [len(t.encode()) for t in texts], n, [k > max_tokens for k in n]]

        return work

    return map_texts(id_and_text(docs, id_col, text_col),
                     "doc_id long, n_bytes long, n_tokens long, over_limit boolean", start)
