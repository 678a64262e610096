"""Benchmark decontamination with suffix arrays over the training text.

Every task gathers documents into shards of a bounded number of words and builds one suffix array for each:
the places of the shard's words, sorted by the words that follow, to the depth of a window. Every suffix of every
benchmark item is binary-searched in it by its first window; the range found holds all its places. Places of one
item on one diagonal are then merged, which gives the longest verbatim matches with their locations in item and
document: matches() returns these, annotate() counts the words that they cover and the items that they belong to,
and clean() drops the documents that have any. Places that can't start a match (a word, or a pair of words, that no
benchmark text holds) are left out of the array, which loses nothing.

Words: A-Z lower-cased, then runs of characters other than ASCII non-alphanumerics. A window is `width`
consecutive words of an item; an item of fewer words, but not none, is one window. A document word inside any
occurrence of a window is hit, and a document with a hit is contaminated.

Null and empty texts have no words and are clean; repeated rows give repeated results; items may repeat or
share windows, and each one counts, rows with the same item id each with their own text; items with a null id are
left out unless `unnamed` is set, as the query and the pipeline do: then their windows hit as all others do, and a
null ends the list of items; an empty table gives an empty result, an empty benchmark leaves all clean. Long texts
form a shard of their own. Columns other than the two named ones are ignored by matches() and annotate() and kept
untouched by clean().

The benchmark is sent to the executors in blocks of items; what a block weighs as sent is bounded by `most_bytes`
(a longer item makes a block of its own), and every shard is searched for one block after the other. A worker holds
one block at a time; the driver keeps all of them, about ten bytes for each byte of benchmark text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, field, fresh, texts

WIDTH, SHARD_WORDS, MOST_BYTES = 10, 1_000_000, 16_000_000
AT_ONCE = 4_000_000  # places that are merged together, but for one document of more

#: Bytes that are no word become spaces, A-Z become a-z; those of characters beyond ASCII stay.
TO_WORDS = bytes(x + 32 if 65 <= x <= 90 else x if x >= 128 or 48 <= x <= 57 or 97 <= x <= 122 else 32 for x in range(256))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(TO_WORDS).split()


def nulls_last(item: str | None) -> tuple[bool, str]:
    return item is None, item or ""


class Windows:
    """The windows of some benchmark texts, as numbers of words in flat arrays. items: (names, text), each text once."""

    def __init__(self, items: list[tuple[list[str | None], str]], width: int = WIDTH):
        self.width, self.ids, self.names = width, {}, [sorted(names, key=nulls_last) for names, _ in items]
        rows, texts_, places = [], [], []
        for at, (_, text) in enumerate(items):
            found = np.array([self.ids.setdefault(w, len(self.ids) + 1) for w in words(text)], np.int32)
            if not len(found):
                continue
            padded = np.concatenate([found, np.zeros(max(0, width - len(found)), np.int32)])
            rows.append(np.lib.stride_tricks.sliding_window_view(padded, width))
            texts_.append(np.full(len(rows[-1]), at, np.int32))
            places.append(np.arange(len(rows[-1]), dtype=np.int32))
        self.windows, inverse = np.unique(np.concatenate(rows), axis=0, return_inverse=True) if rows else (np.zeros((0, width), np.int32), np.zeros(0, int))
        order = np.argsort(inverse.ravel(), kind="stable")
        # the texts that hold window k, and where: text and place from start[k] to start[k + 1]
        self.text, self.place = (np.concatenate(x)[order] if rows else np.zeros(0, np.int32) for x in (texts_, places))
        self.start = np.searchsorted(inverse.ravel()[order], np.arange(len(self.windows) + 1))
        self.lengths = (self.windows > 0).sum(1)

    def n_bytes(self) -> int:
        return sum(x.nbytes for x in (self.windows, self.text, self.place, self.start, self.lengths)) + sum(len(w) + 40 for w in self.ids)

    @cached_property
    def keys(self) -> tuple[np.ndarray, ...]:
        """First and second words of windows in one number, windows of one word, and the bytes that all suffixes
        with a window lie between."""
        pairs = self.windows[self.lengths > 1, :2].astype(np.int64) @ np.array([len(self.ids) + 1, 1]) if self.width > 1 else np.zeros(0, np.int64)
        raw = self.windows.astype(">u4").view(np.uint8).reshape(len(self.windows), 4 * self.width)
        behind = np.arange(4 * self.width) >= 4 * self.lengths[:, None]
        after = np.hstack([np.where(behind, 255, raw), np.full((len(raw), 1), 255)]).astype(np.uint8)
        return np.unique(pairs), np.unique(self.windows[self.lengths == 1, 0]), np.ascontiguousarray(raw).view(f"S{4 * self.width}").ravel(), after.view(f"S{4 * self.width + 1}").ravel()

    def search(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, window) of every occurrence in numbers, in which 0 is any word that no item holds."""
        none = np.zeros(0, np.int64)
        if not len(self.windows) or not len(numbers):
            return none, none
        pairs, single, first, after = self.keys
        here, then = numbers[:-1].astype(np.int64), numbers[1:]
        code = here * (len(self.ids) + 1) + then
        places = np.flatnonzero((here > 0) & (then > 0))
        places = places[np.isin(code[places], pairs)]
        if len(single):
            places = np.union1d(places, np.flatnonzero(np.isin(numbers, single)))
        if not len(places):
            return none, none
        padded = np.concatenate([numbers, np.zeros(self.width, numbers.dtype)]).astype(">u4")
        suffixes = np.lib.stride_tricks.sliding_window_view(padded, self.width)[places]
        keys = np.ascontiguousarray(suffixes).view(f"S{4 * self.width}").ravel()
        order = np.argsort(keys, kind="stable")  # the suffix array
        keys, places = keys[order], places[order]
        low, high = np.searchsorted(keys, first, "left"), np.searchsorted(keys, after, "left")
        n = high - low
        at = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
        return places[at], np.repeat(np.arange(len(n)), n)


class Runs(NamedTuple):
    """Longest matches: row of the shard, text of the block, first word in the text and in the shard, words."""

    row: np.ndarray
    text: np.ndarray
    item_word: np.ndarray
    place: np.ndarray
    n: np.ndarray


def longest(windows: Windows, places: np.ndarray, which: np.ndarray, rows: np.ndarray) -> Iterator[Runs]:
    """The matches that these occurrences of windows make up, document after document."""
    by_row = np.argsort(rows, kind="stable")
    places, which, rows = places[by_row], which[by_row], rows[by_row]
    n = windows.start[which + 1] - windows.start[which]
    so_far = np.cumsum(n)
    a = 0
    while a < len(rows):
        b = int(np.searchsorted(so_far, (so_far[a - 1] if a else 0) + AT_ONCE, "right"))
        # whole documents: to the last border, or to the end of the first one
        b = len(rows) if b >= len(rows) else int(np.searchsorted(rows, rows[b], "left"))
        b = b if b > a else int(np.searchsorted(rows, rows[a], "right"))
        m, w = n[a:b], which[a:b]
        at = np.repeat(windows.start[w] - np.cumsum(m) + m, m) + np.arange(m.sum())
        text, item_word = windows.text[at], windows.place[at].astype(np.int64)
        place, row, size = np.repeat(places[a:b], m), np.repeat(rows[a:b], m), np.repeat(windows.lengths[w], m)
        order = np.lexsort((place, place - item_word, text))
        text, item_word, place, row, size = (x[order] for x in (text, item_word, place, row, size))
        shift, end = place - item_word, place + size
        # windows of a text have one length, so on a diagonal ends come in order; a word between rows parts them
        new = np.ones(len(text), bool)
        new[1:] = (text[1:] != text[:-1]) | (shift[1:] != shift[:-1]) | (place[1:] > end[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(text)) - 1
        yield Runs(row[first], text[first], item_word[first], place[first], end[last] - place[first])
        a = b


def _shards(batches, limit: int, text: int = 1):
    """Gathers batches into lists of limit words at least, with the words of each row (column `text`)."""
    held, found, n = [], [], 0
    for batch in batches:
        held.append(batch)
        for x in batch.column(text).to_pylist():
            found.append(words(x))
            n += len(found[-1])
        if n >= limit:
            yield held, found
            held, found, n = [], [], 0
    if held:
        yield held, found


def _located(windows: Windows, found: list[list[bytes]]) -> tuple[Iterator[Runs], np.ndarray]:
    """The longest matches of a shard, and where its rows start."""
    sizes = np.array([len(x) for x in found], np.int64)
    starts = np.cumsum(sizes + 1) - sizes - 1
    number = windows.ids.get
    flat = np.fromiter((y for x in found for y in (*[number(w, 0) for w in x], 0)), np.int32, int(sizes.sum() + len(sizes)))
    places, which = windows.search(flat)
    return longest(windows, places, which, np.searchsorted(starts, places, "right") - 1), starts


_last: list = []


def taken(block):
    """The value of a block, of which a worker keeps only the last one."""
    if _last and _last[0] is block:
        return _last[1]
    value = block.value
    block.__dict__.pop("_value", None)
    _last[:] = [block, value]
    return value


def _blocks(bench: DataFrame, item_col: str, text_col: str, width: int, most_bytes: int, unnamed: bool = False) -> Iterator[Windows]:
    """Windows of most_bytes each at most, as they are sent; an item alone may have more."""
    block: dict[str, list[str | None]] = {}
    size = 0
    for item, text in bench.select(F.col(item_col).cast("string"), text_col).toLocalIterator():
        if item is None and not unnamed or not text:
            continue
        own = len(words(text)) * (4 * width + 64)  # a row of the flat array, where it is, and perhaps a new word
        if block and text not in block and size + own > most_bytes:
            yield Windows([(names, x) for x, names in block.items()], width)
            block, size = {}, 0
        size += 0 if text in block else own
        block.setdefault(text, []).append(item)
    if block:
        yield Windows([(names, x) for x, names in block.items()], width)


def _sent(docs: DataFrame, bench: DataFrame, item_col: str, text_col: str, width: int, most_bytes: int, unnamed: bool) -> list:
    bounded_batches(docs.sparkSession)
    return [docs.sparkSession.sparkContext.broadcast(x) for x in _blocks(bench, item_col, text_col, width, most_bytes, unnamed)]


def annotate(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", width: int = WIDTH, shard_words: int = SHARD_WORDS, most_bytes: int = MOST_BYTES, unnamed: bool = False, item_text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_hit, items, contaminated) for every row; items are the ids as strings, sorted."""
    sent = _sent(docs, bench, item_col, item_text_col, width, most_bytes, unnamed)

    def run(batches):
        for held, found in _shards(batches, shard_words):
            total = sum(len(x) + 1 for x in found)
            starts = np.cumsum([0, *(len(x) + 1 for x in found[:-1])])
            edge, items = np.zeros(total + 1, np.int64), [set() for _ in found]
            for block in sent:  # one block's windows after the other over the same shard
                windows = taken(block)
                for runs in _located(windows, found)[0]:
                    np.add.at(edge, runs.place, 1)
                    np.add.at(edge, runs.place + runs.n, -1)
                    for row, text in zip(*np.unique([runs.row, runs.text], axis=1).tolist(), strict=True):
                        items[row].update(windows.names[text])
            n_hit = np.add.reduceat(np.cumsum(edge[:-1]) > 0, starts).tolist()
            out = [
                pa.concat_arrays([x.column(0) for x in held]),
                pa.array([len(x) for x in found], pa.int64()),
                pa.array(n_hit, pa.int64()),
                pa.array([sorted(x, key=nulls_last) for x in items], pa.list_(pa.string())),
            ]
            yield pa.RecordBatch.from_arrays(out, ["doc_id", "n_words", "n_hit", "items"])

    schema = T.StructType([field(docs, id_col, "doc_id"), T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("items", T.ArrayType(T.StringType()))])
    return texts(docs, id_col, text_col).mapInArrow(run, schema).withColumn("contaminated", F.col("n_hit") > 0)


def matches(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", width: int = WIDTH, shard_words: int = SHARD_WORDS, most_bytes: int = MOST_BYTES, unnamed: bool = False, item_text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, item_word, doc_word, n_words): the longest verbatim matches of at least a window."""
    sent = _sent(docs, bench, item_col, item_text_col, width, most_bytes, unnamed)

    def run(batches):
        for held, found in _shards(batches, shard_words):
            ids = pa.concat_arrays([x.column(0) for x in held])
            for block in sent:
                windows = taken(block)
                located, starts = _located(windows, found)
                for runs in located:
                    names = [windows.names[k] for k in runs.text.tolist()]
                    again = np.repeat(np.arange(len(names)), [len(x) for x in names])
                    columns = (runs.item_word, runs.place - starts[runs.row], runs.n)
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(runs.row[again])), pa.array([y for x in names for y in x], pa.string()), *(pa.array(x[again], pa.int64()) for x in columns)], ["doc_id", "item_id", "item_word", "doc_word", "n_words"])

    schema = T.StructType([field(docs, id_col, "doc_id"), T.StructField("item_id", T.StringType()), *(T.StructField(x, T.LongType()) for x in ("item_word", "doc_word", "n_words"))])
    return texts(docs, id_col, text_col).mapInArrow(run, schema)


def clean(docs: DataFrame, bench: DataFrame, text_col: str = "text", item_col: str = "item_id", width: int = WIDTH, shard_words: int = SHARD_WORDS, most_bytes: int = MOST_BYTES, unnamed: bool = False, item_text_col: str = "text") -> DataFrame:
    """The rows of docs without any match, with all their columns."""
    sent = _sent(docs, bench, item_col, item_text_col, width, most_bytes, unnamed)
    columns = len(docs.columns)

    def run(batches):
        for held, found in _shards(batches, shard_words, columns):
            dirty = np.zeros(len(found), bool)
            for block in sent:
                for runs in _located(taken(block), found)[0]:
                    dirty[runs.row] = True
            at = 0
            for batch in held:
                keep = pa.array(~dirty[at : at + batch.num_rows])
                at += batch.num_rows
                yield pa.RecordBatch.from_arrays(batch.columns[:columns], batch.schema.names[:columns]).filter(keep)

    return docs.withColumn(fresh(docs, "__text"), F.col(text_col)).mapInArrow(run, docs.schema)
