"""Token counts with overlap resynchronisation for huge documents.

Short texts go to the library as they are. A text over chunk characters is encoded in overlapping chunks with
offsets. Two neighbours are spliced at a place inside of their overlap where both start a token and that is
proven stable: the pair of characters around it occurs inside of no piece of the vocabulary, so no merge can
ever cross it, and the tokens on its two sides don't depend on each other. Where an overlap holds no such
place it is widened to the left, and in the end the chunk is encoded anew together with the next one. Models of
which this isn't proven (that normalise the text, merge otherwise than by byte pairs, or have no bytes for unknown
characters) take no chunks: their texts are encoded in one piece.

Null and empty texts have 0 tokens; repeated rows give repeated results; an empty table gives an empty one.
Columns other than the two named ones are ignored.
"""

from __future__ import annotations

import sys
from bisect import bisect_left
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import field, texts

CHUNK, OVERLAP = 50_000, 256


def fields(data: bytes) -> dict[int, list]:
    """The fields of a protocol buffers message, by number: integers, and bytes as they are."""

    def number(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            value |= (data[at] & 127) << shift
            shift += 7
            at += 1
            if data[at - 1] < 128:
                return value, at

    out: dict[int, list] = {}
    at = 0
    while at < len(data):
        tag, at = number(at)
        if tag & 7 == 0:
            value, at = number(at)
        else:
            size, at = number(at) if tag & 7 == 2 else (8 if tag & 7 == 1 else 4, at)
            value, at = data[at : at + size], at + size
        out.setdefault(tag >> 3, []).append(value)
    return out


def can_splice(model: bytes) -> bool:
    """Whether the proof below holds for a model: byte pair merges, text taken as it is, spaces kept as their own
    sign, bytes for unknown characters (numbers of fields as in the library's published format)."""
    parts = fields(model)
    trainer, normalizer = (fields(parts.get(k, [b""])[-1]) for k in (2, 3))
    last = lambda x, k, other: x.get(k, [other])[-1]
    return last(trainer, 3, 1) == 2 and last(trainer, 35, 0) == 1 and not last(normalizer, 2, b"") and not last(normalizer, 4, 1) and bool(last(normalizer, 5, 1)) and not last(trainer, 24, 0)


class PieceCounter:
    def __init__(self, path: str, chunk: int = CHUNK, overlap: int = OVERLAP):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.inside = {x[i : i + 2] for k in range(self.model.get_piece_size()) for x in [self.model.id_to_piece(k)] for i in range(len(x) - 1)}
        self.chunk, self.overlap = chunk if can_splice(self.model.serialized_model_proto()) else sys.maxsize, overlap

    def stable(self, text: str, at: int) -> bool:
        return text[at - 1 : at + 1].replace(" ", "▁") not in self.inside

    def starts(self, text: str, lo: int, hi: int) -> list[int]:
        """Where the tokens of text[lo:hi] start, as places in text."""
        part = text[lo:hi]
        begins = [p.begin for p in self.model.encode(part, return_type="proto").pieces]  # in bytes
        raw = np.frombuffer(part.encode(), np.uint8)
        place = np.cumsum((raw & 0xC0) != 0x80) - 1
        return (lo + place[begins]).tolist()

    def count(self, text: str) -> int:
        """Tokens of a huge text. Chunk [lo, hi) counts from place `first` on."""
        total, lo, hi, first = 0, 0, min(self.chunk, len(text)), 0
        tokens = self.starts(text, lo, hi)
        while hi < len(text):
            overlap = self.overlap
            while True:
                start = hi - overlap
                if start <= first:  # nothing left to widen: this chunk and the next one become one
                    hi = min(len(text), hi + self.chunk)
                    tokens = self.starts(text, lo, hi)
                    break
                end = min(len(text), hi + self.chunk)
                after = self.starts(text, start, end)
                common = {*after[bisect_left(after, start + 1) :]}
                splice = next((x for x in tokens[bisect_left(tokens, start + 1) :] if x < hi and x in common and self.stable(text, x)), None)
                if splice is not None:
                    total += bisect_left(tokens, splice) - bisect_left(tokens, first)
                    lo, hi, first, tokens = start, end, splice, after
                    break
                overlap *= 2
        return total + len(tokens) - bisect_left(tokens, first)

    def counts(self, batch: list[str]) -> list[int]:
        short = iter([len(x) for x in self.model.encode([x for x in batch if len(x) <= self.chunk], num_threads=1)])
        return [next(short) if len(x) <= self.chunk else self.count(x) for x in batch]


@lru_cache(maxsize=4)
def counter(path: str, chunk: int, overlap: int) -> PieceCounter:
    return PieceCounter(path, chunk, overlap)


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row."""

    def run(batches):
        model = counter(path, chunk, overlap)
        for batch in batches:
            n = model.counts(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    schema = T.StructType([field(docs, id_col, "doc_id"), T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])
    rows = texts(docs, id_col, text_col).withColumn("n_bytes", F.octet_length("text").cast("long"))
    return rows.mapInArrow(run, schema).withColumn("over_limit", F.col("n_tokens") > limit)
