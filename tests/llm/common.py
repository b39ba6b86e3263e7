"""Fixtures shared by the tests of the training-data operators."""

import os
import random
import re

import pytest

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(name):
    return pytest.importorskip("public_tokenizers").path(name)


def odd_texts(n=120, alphabet="abcdefetinr \n'sé日́Σİ1-$<|>\x1c\xa0\t\r▁", seed=3):
    rnd = random.Random(seed)
    fixed = ["", " ", "  ", "a" * 900, "  A  b\n c\t d ", "日本😀 <s> </s> <|endoftext|>x <|startoftext|>", "ΑΣ ΣΑΣ x",
             "\x00 ​ a　b \r\n x;\r y", "it's I'LL 123 a1b2", "áe ́x a\x1cb \x85z", "ababab" * 300 + " foo", "\n\n\n"]
    return fixed + ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(400))) for _ in range(n)]


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


class Sets:
    """Union-find for brute-force answers."""

    def __init__(self, ids):
        self.up = {i: i for i in ids}

    def root(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)


def sentences(rnd, n, vocabulary=400):
    return " ".join(f"w{rnd.randrange(vocabulary)}x{rnd.randrange(9)}" for _ in range(n))
