"""Byte-level BPE encoding and decoding by monoid tree reduction.

A text is halved until its parts are short; each leaf is encoded by itself. Two neighbours are joined by
re-encoding a window around their border. The window grows on both sides until it ends at a cut that no
match of the splitting pattern can cross (a non-space character followed by a plain space or line end): the
pattern has no look-behind, none of its branches holds a space behind another character, so matches on the
two sides of such a cut are independent of each other, and every token outside of the window stays as it is.
Without such a cut the window grows to the whole of that side, which is exact as well. Patterns of which this isn't
proven (PROVEN) take no halves: their texts are encoded in one piece.
Decoding concatenates the bytes of the tokens up the same kind of tree.

Null and empty texts have no tokens; repeated rows give repeated results; an empty table gives an empty one.
Columns other than the two named ones are ignored, so their names can't clash.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import field, texts

#: Splitting patterns of which the rule of cuts is proven (no look-behind, and in no branch can a space
#: or line end follow another character). Texts are encoded in one piece with any other.
PROVEN = (r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""",)

#: Characters of a leaf of the tree, and of the first window on each side of a border.
LEAF, WINDOW = 16_384, 16


class TreeBPE:
    """Encodes like one pass over the whole text, but with work bounded by leaves and windows."""

    def __init__(self, path: str, pattern: str, leaf: int = LEAF):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.coder = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.n_bytes = [0] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.n_bytes[rank] = len(token)
        self.leaf = leaf
        self.whole = pattern not in PROVEN

    def encode(self, text: str) -> list[int]:
        return self._encode(text, 0, len(text))

    def _encode(self, text: str, lo: int, hi: int) -> list[int]:
        if hi - lo <= self.leaf or self.whole:
            return self.coder.encode_ordinary(text[lo:hi])
        mid = (lo + hi) // 2
        return self._join(text, lo, mid, hi, self._encode(text, lo, mid), self._encode(text, mid, hi))

    def _join(self, text: str, lo: int, mid: int, hi: int, left: list[int], right: list[int]) -> list[int]:
        if is_cut(text, mid):
            return left + right
        start, end = cut_before(text, lo, mid), cut_after(text, mid, hi)
        window = self.coder.encode_ordinary(text[start:end])
        keep, size = len(left), len(text[start:mid].encode())
        while size > 0:
            keep -= 1
            size -= self.n_bytes[left[keep]]
        skip, size = 0, len(text[mid:end].encode())
        while size > 0:
            size -= self.n_bytes[right[skip]]
            skip += 1
        return left[:keep] + window + right[skip:]

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) <= self.leaf:
            return self.coder.decode_bytes(ids)
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


def is_cut(text: str, at: int) -> bool:
    return text[at] in " \n\t\r" and not text[at - 1].isspace()


def cut_before(text: str, lo: int, mid: int) -> int:
    """The last cut before mid in growing windows, or lo."""
    seen, width = mid, WINDOW
    while seen > lo:
        first = max(lo, mid - width)
        for at in range(seen - 1, max(first, lo + 1) - 1, -1):
            if is_cut(text, at):
                return at
        seen, width = first, width * 2
    return lo


def cut_after(text: str, mid: int, hi: int) -> int:
    """The first cut after mid in growing windows, or hi."""
    seen, width = mid + 1, WINDOW
    while seen < hi:
        last = min(hi, mid + width)
        for at in range(seen, last):
            if is_cut(text, at):
                return at
        seen, width = max(last, seen), width * 2
    return hi


@lru_cache(maxsize=4)
def coder(path: str, pattern: str, leaf: int = LEAF) -> TreeBPE:
    return TreeBPE(path, pattern, leaf)


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False, leaf: int = LEAF) -> DataFrame:
    """(doc_id, ids) for every row, with decoded=True also the bytes that the ids decode to."""

    def run(batches):
        bpe = coder(path, pattern, leaf)
        for batch in batches:
            ids = [bpe.encode(x) for x in batch.column(1).to_pylist()]
            out = [batch.column(0), pa.array(ids, pa.list_(pa.int32()))]
            if decoded:
                out.append(pa.array([bpe.decode(x) for x in ids], pa.binary()))
            yield pa.RecordBatch.from_arrays(out, names[: len(out)])

    names = ["doc_id", "ids", "decoded"]
    schema = T.StructType([field(docs, id_col, "doc_id"), T.StructField("ids", T.ArrayType(T.IntegerType()))] + [T.StructField("decoded", T.BinaryType())] * decoded)
    return texts(docs, id_col, text_col).mapInArrow(run, schema)


def decode(tokens: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, decoded) for rows with ids; null lists give empty bytes."""

    def run(batches):
        bpe = coder(path, pattern)
        for batch in batches:
            out = [bpe.decode(x or []) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["doc_id", "decoded"])

    schema = T.StructType([field(tokens, id_col, "doc_id"), T.StructField("decoded", T.BinaryType())])
    return tokens.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids")).mapInArrow(run, schema)


def digests(encoded: DataFrame, *more: str) -> DataFrame:
    """The digest columns of rows from encode(..., decoded=True), and those named."""
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        *more,
    )
