import random

import public_tokenizers as P
import pytest

from lodestone.llm import token_counts as C

PATH = P.path("piece_bpe_32k.model")
PARTS = ["a", "b", "the ", "ing", "  ", "\n", " ", "é", "日本", "!", "12", "x", "▁", "</s>", "<s>", "\t", "token", "\U0001f600", "\x00"]


@pytest.mark.parametrize("chunk,overlap", [(11, 2), (20, 3), (50, 8)])
def test_spliced_equals_whole(chunk, overlap):
    model, rng = C.PieceCounter(PATH, chunk, overlap), random.Random(chunk)
    for _ in range(800):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 90)))
        assert model.counts([text]) == [len(model.model.encode(text))]


@pytest.mark.parametrize("text", [" " * 3000, "a" * 3000, "\n" * 2000, "日本" * 900, "word " * 3000])
def test_texts_without_stable_places(text):
    model = C.PieceCounter(PATH, 100, 10)
    assert model.count(text) == len(model.model.encode(text))


def test_rows(spark):
    ddl = "doc_id long, text string, n_bytes string, over_limit int"
    long_ = "Überall the same words and others. " * 4000
    data = [(1, "héllo", "", 0), (2, None, "", 0), (3, "", "", 0), (None, "x", "", 0), (4, long_, "", 0), (1, "héllo", "", 0)]
    df = spark.createDataFrame(data, ddl)
    model = C.PieceCounter(PATH).model
    got = sorted((tuple(r) for r in C.count_tokens(df, PATH).collect()), key=str)
    n = lambda x: len(model.encode(x or ""))
    assert got == sorted(((d, len((t or "").encode()), n(t), n(t) > 4096) for d, t, *_ in data), key=str)
    assert C.count_tokens(df.limit(0), PATH).count() == 0


def test_models_without_a_proof_take_whole_texts():
    """Merges by byte pairs, no normalisation, bytes for unknown characters: one of these missing is enough."""
    number = lambda field, value: bytes([*varint(field << 3), *varint(value)])
    text = lambda field, value: bytes([*varint(field << 3 | 2), *varint(len(value)), *value])

    def varint(n):
        return [n] if n < 128 else [n & 127 | 128, *varint(n >> 7)]

    trainer, plain = number(3, 2) + number(35, 1), number(4, 0)
    model = lambda t, n: text(1, b"\n\x01a") + text(2, t) + text(3, n)
    assert C.can_splice(model(trainer, plain))
    for t, n in ((number(3, 1) + number(35, 1), plain), (number(3, 2), plain), (trainer, b""), (trainer, plain + text(2, b"map")), (trainer, plain + number(5, 0))):
        assert not C.can_splice(model(t, n))
