"""Token counts, transducer encoding and packing against the public libraries."""

import hashlib
import zlib

import numpy as np
import pytest

from isohyet.llm import bpe_transducer, ragged_merge, sumsquares_packing, token_counts
from tests.llm.common import frame, odd_texts, path


def test_counts_equal_the_library(spark):
    import sentencepiece

    model = path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=model)
    texts = odd_texts()
    got = token_counts.token_counts(frame(spark, list(enumerate(texts))), model, 50).collect()
    assert {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in got} == {
        i: (len(t.encode()), len(library.encode(t)), len(library.encode(t)) > 50) for i, t in enumerate(texts)}


def test_long_sequences_merge_as_short_ones_do():
    table = ragged_merge.MergeTable([0, 2, 1], [1, 1, 0], [2, 3, 4], [0, 2, 1], 5)
    rng = np.random.default_rng(5)
    parts = [rng.integers(0, 2, n) for n in (0, 1, 2, 7, 300, 399)]
    kept, sizes = table.merge(np.concatenate(parts), [len(p) for p in parts])
    assert kept.tolist() == np.concatenate([table.merge_long(p) for p in parts if len(p)]).tolist()
    assert sizes.tolist() == [len(table.merge_long(p)) if len(p) else 0 for p in parts]


def test_encoding_equals_the_library(spark):
    import tokenizers

    file = path("word_bpe_49k.json")
    library = tokenizers.Tokenizer.from_file(file)
    texts = odd_texts() + ["the cat the dog " * 5]
    got = bpe_transducer.encode(frame(spark, list(enumerate(texts))), file, max_words=40, with_ids=True).collect()
    for row in got:
        ids = library.encode(texts[row["doc_id"]], add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert row["ids"] == ids and row["decoded"] == decoded and row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()


def test_transducer_shares_suffixes_and_maps_words_to_ids(tmp_path):
    words = sorted({a + b for a in ("walk", "talk", "jump", "dé") for b in ("", "s", "ed", "ing", "ingly")})
    built = bpe_transducer.Transducer.compile({w: [i, i + 100] for i, w in enumerate(words)})
    assert len(built.final) < 30  # a trie of these words has over 50 states
    (tmp_path / "lexicon").write_bytes(built.to_bytes())
    mapped = bpe_transducer.Transducer.mapped(str(tmp_path / "lexicon"))
    number = mapped.look_up([*words, "wal", "walkedx", "", "zz"])
    assert [mapped.ids_of(k) for k in number[:len(words)]] == [[i, i + 100] for i in range(len(words))]
    assert (number[len(words):] == -1).all()


def test_lexicon_takes_the_most_frequent_words(spark):
    docs = frame(spark, [(1, "aa aa aa bb bb cc"), (2, "aa bb dd"), (3, None)])
    counts = {r["word"]: r["n"] for r in bpe_transducer.word_counts(docs, path("word_bpe_49k.json")).collect()}
    assert counts == {"aa": 4, "bb": 3, "cc": 1, "dd": 1}
    lexicon = bpe_transducer.build_lexicon(docs, path("word_bpe_49k.json"), max_words=1)
    assert (lexicon.look_up(["aa", "bb", "cc"]) >= 0).tolist() == [True, False, False]


def test_packing_keeps_every_token_and_fills_sequences(spark):
    import tokenizers

    file = path("byte_bpe_50k.json")
    library = tokenizers.Tokenizer.from_file(file)
    texts = odd_texts(300) + ["word " * 700, "x y " * 2000]
    rows = sumsquares_packing.pack_documents(frame(spark, list(enumerate(texts))), file, capacity=256, shard_pieces=150).collect()
    pieces = {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
    for i, t in enumerate(texts):
        ids = np.array(library.encode(t, add_special_tokens=False).ids + [2], "<u4")
        own = sorted(pieces[i], key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(len(own))) and sum(r["length"] for r in own) == len(ids)
        assert all(r["length"] == 256 for r in own[1:]) and own[0]["start"] == 0
        for r in own:
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"]:r["start"] + r["length"]].tobytes())
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    least = -(-sum(r["length"] for r in rows) // 256)
    assert len(by_sequence) <= 1.06 * least + 4


def test_sum_of_squares_choice():
    # Open gaps 4 (once) and 6 (twice) of ten: the item of 3 leaves 1 or 3; taking from the doubled gap lowers the sum more.
    bins, offsets = sumsquares_packing.pack(np.array([6, 4, 4, 3]), 10)
    assert bins[0] == 0 and bins[1] == 0 and offsets[1] == 6 and bins[2] == bins[3] == 1 and offsets[3] == 4


@pytest.mark.parametrize("n", [1, 500])
def test_decreasing_packing_is_near_the_bound(n):
    lengths = np.random.default_rng(n).integers(1, 1024, n)
    bins, _ = sumsquares_packing.pack(lengths, 1024)
    assert np.bincount(bins, weights=lengths).max() <= 1024 and bins.max() + 1 <= 1.05 * lengths.sum() / 1024 + 2


def test_files_whose_ids_are_no_ranks_use_their_own_library(tmp_path):
    """A file with a prefix space, and one with ids in another order, against the file's own library."""
    import json

    import numpy as np
    from tokenizers import Tokenizer

    from isohyet.llm import sumsquares_packing as packing

    given = path("byte_bpe_50k.json")
    spec = json.loads(Tokenizer.from_file(given).to_str())
    assert packing.ids_are_ranks(spec)
    texts = ["Hello world", " it's 12  apples", "", "a b c"]
    prefixed = json.loads(json.dumps(spec))
    prefixed["pre_tokenizer"]["add_prefix_space"] = True
    swapped = json.loads(json.dumps(spec))
    merges = swapped["model"]["merges"]
    (a, b), (c, d) = (m.split(" ") if isinstance(m, str) else m for m in merges[:2])
    vocab = swapped["model"]["vocab"]
    vocab[a + b], vocab[c + d] = vocab[c + d], vocab[a + b]
    for i, other in enumerate((prefixed, swapped)):
        assert not packing.ids_are_ranks(other)
        file = str(tmp_path / f"{i}.json")
        with open(file, "w") as f:
            json.dump(other, f)
        own = Tokenizer.from_file(file)
        for text, ids in zip(texts, packing.ByteBpe(file, 2).encode(texts)):
            assert np.frombuffer(ids, "<u4").tolist() == own.encode(text, add_special_tokens=False).ids + [2]
