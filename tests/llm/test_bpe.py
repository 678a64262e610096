import hashlib
import random

import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lodestone.llm import bpe

PATH = P.path("byte_bpe_50k.tiktoken")
PARTS = ["a", "b'", "'re", "'s", "  ", "\n", " ", "é", "日本", "!", "12", "x", "'", "l", "ll", "\t", "\x1c", "\u0085", "the", "<|endoftext|>"]


@pytest.mark.parametrize("leaf", [2, 5, 40])
def test_tree_equals_one_pass(leaf):
    tree, rng = bpe.TreeBPE(PATH, P.PATTERN, leaf), random.Random(leaf)
    for _ in range(800):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 60)))
        ids = tree.encode(text)
        assert ids == tree.coder.encode_ordinary(text)
        assert tree.decode(ids) == text.encode()


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80))
def test_any_text(text):
    tree = bpe.coder(PATH, P.PATTERN, 4)
    assert tree.encode(text) == tree.coder.encode_ordinary(text) and tree.decode(tree.encode(text)) == text.encode()


@pytest.mark.parametrize("text", [" " * 5000, "a" * 5000, "\n" * 3001, "ab1 " * 20000, "'" * 4000, "日" * 3000])
def test_runs_without_a_cut(text):
    tree = bpe.coder(PATH, P.PATTERN, 64)
    assert tree.encode(text) == tree.coder.encode_ordinary(text)


def test_rows(spark):
    ddl = "doc_id long, text string, ids string, decoded int, n_tokens int"
    data = [(1, "hello world", "", 0, 0), (2, None, "", 0, 0), (3, "", "", 0, 0), (None, "x", "", 0, 0), (1, "hello world", "", 0, 0), (4, "word " * 40000, "", 0, 0)]
    df = spark.createDataFrame(data, ddl)
    encoded = bpe.encode(df, PATH, P.PATTERN, decoded=True)
    got = bpe.digests(encoded).collect()
    tree = bpe.coder(PATH, P.PATTERN)
    want = []
    for doc, text, *_ in data:
        ids = tree.coder.encode_ordinary(text or "")
        want.append((doc, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    back = bpe.decode(encoded.drop("decoded"), PATH, P.PATTERN).collect()
    assert sorted(bytes(r.decoded) for r in back) == sorted((x[1] or "").encode() for x in data)
    assert bpe.encode(df.limit(0), PATH, P.PATTERN).count() == 0


def test_patterns_without_a_proof_take_whole_texts():
    """A sign may take the line end behind it here, so a cut ahead of a line end would part a match."""
    pattern = r"""[^\s\p{L}\p{N}]+[\r\n]*| ?\p{L}+|\s+|\p{N}"""
    tree = bpe.TreeBPE(PATH, pattern, 4)
    for text in ("a!\nb " * 30, "...\r\n" * 20):
        assert tree.encode(text) == tree.coder.encode_ordinary(text)
