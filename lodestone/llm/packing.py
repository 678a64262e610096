"""Token-ID output: documents packed into fixed rows of ids by best-fit decreasing.

Documents are dealt by a hash of id and text into shards of about shard_bytes (rows without an id also by their
place), and each shard is packed by itself, in parts of at most four times that size: so a task never holds more
than a part and one document, even if very many rows are the same.
Every text is encoded and closed with an end id; one longer than a row is split into consecutive pieces
without loss. Pieces go, longest first, to the fullest row that still has room; a segment tree over the
possible capacities finds that row in O(log row length). A shard gives a matrix of ids (one binary row for
each packed row, little endian, padded), with cumulative segment lengths and position ids that start again at 0
in each segment. Rows are cut off at nothing: the bounds on shards and parts only say which pieces are packed
together, so that a part ends with rows that pieces of the next one might have filled.

Null and empty texts give a piece that holds the end id alone; null ids stay null in doc_ids; repeated rows are
packed each; ids of any type stay as they are; an empty table gives no rows. Ties in length go by (doc_id, hash of text, piece), nulls first,
so the result doesn't depend on how the input is split (for rows without an id it may). Columns other than the two named ones are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .bpe import coder
from .common import texts

#: Ids in a row, bytes of text dealt to a shard on average, the id that ends a document and fills up rows.
ROW, SHARD_BYTES, END = 2048, 6_000_000, 50256


class CapacityTree:
    """Rows by free capacity; fit(n) takes the row with the least capacity of n or more."""

    def __init__(self, most: int):
        self.half = 1 << most.bit_length()
        self.count = [0] * (2 * self.half)
        self.rows: list[list[int]] = [[] for _ in range(most + 1)]

    def put(self, row: int, capacity: int) -> None:
        self.rows[capacity].append(row)
        self._add(capacity, 1)

    def _add(self, capacity: int, n: int) -> None:
        at = capacity + self.half
        while at:
            self.count[at] += n
            at >>= 1

    def fit(self, n: int) -> tuple[int, int] | None:
        """(row, its capacity), taken out of the tree; None if no row has n free."""
        at = n + self.half
        while not self.count[at]:
            while at & 1:
                at >>= 1
                if at <= 1:
                    return None
            if at <= 1:
                return None
            at += 1
        while at < self.half:
            at = 2 * at if self.count[2 * at] else 2 * at + 1
        capacity = at - self.half
        self._add(capacity, -1)
        return self.rows[capacity].pop(), capacity


def best_fit_decreasing(lengths: list[int], row: int) -> list[list[int]]:
    """Places of the pieces, row by row; no length is over row."""
    tree, packed = CapacityTree(row), []
    for k in sorted(range(len(lengths)), key=lambda k: (-lengths[k], k)):
        found = tree.fit(lengths[k])
        if found is None:
            packed.append([k])
            tree.put(len(packed) - 1, row - lengths[k])
        else:
            packed[found[0]].append(k)
            tree.put(found[0], found[1] - lengths[k])
    return packed


def schema(doc_id: T.DataType) -> T.StructType:
    """Of packed rows; doc_ids keep the type of the ids."""
    columns = [(x, T.IntegerType()) for x in ("shard", "part", "row", "n_tokens")] + [("doc_ids", T.ArrayType(doc_id)), ("pieces", T.ArrayType(T.IntegerType())), ("cu_seqlens", T.ArrayType(T.IntegerType())), ("input_ids", T.BinaryType()), ("position_ids", T.BinaryType())]
    return T.StructType([T.StructField(*x) for x in columns])


def pack(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", row: int = ROW, end: int = END, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One line per packed row: its ids as little-endian uint16 (uint32 if an id needs it), segment i being
    document doc_ids[i], piece pieces[i], at cu_seqlens[i] to cu_seqlens[i + 1]."""
    rows = texts(docs, id_col, text_col)
    total = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    shards = max(1, -(-total // shard_bytes))

    def packed(shard: int, part: int, owners: list, numbers: list, parts: list) -> pa.RecordBatch:
        out: dict[str, list] = {x: [] for x in names}
        for at, members in enumerate(best_fit_decreasing([len(x) for x in parts], row)):
            sizes = [len(parts[k]) for k in members]
            ids, places = np.full(row, end, parts[0].dtype), np.zeros(row, np.uint16 if row <= 0xFFFF else np.uint32)
            ids[: sum(sizes)] = np.concatenate([parts[k] for k in members])
            places[: sum(sizes)] = np.concatenate([np.arange(n) for n in sizes])
            line = (shard, part, at, sum(sizes), [owners[k] for k in members], [numbers[k] for k in members], np.cumsum([0, *sizes]).tolist(), ids.tobytes(), places.tobytes())
            for x, value in zip(names, line, strict=True):
                out[x].append(value)
        return pa.RecordBatch.from_pydict(out, schema=arrow)

    def run(batches):
        bpe = coder(path, pattern)
        kind = np.uint16 if max(end, len(bpe.n_bytes)) <= 0xFFFF else np.uint32
        now, part, size, owners, numbers, parts = None, 0, 0, [], [], []
        for batch in batches:
            for doc_id, text, shard in zip(*(x.to_pylist() for x in batch.columns[:3]), strict=True):
                if shard != now or size > 4 * shard_bytes:
                    if parts:
                        yield packed(now, part, owners, numbers, parts)
                    now, part, size, owners, numbers, parts = shard, part + 1 if shard == now else 0, 0, [], [], []
                ids = np.asarray([*bpe.encode(text), end], kind)
                size += len(text.encode()) + 64
                for i in range(0, len(ids), row):
                    owners.append(doc_id)
                    numbers.append(i // row)
                    parts.append(ids[i : i + row])
        if parts:
            yield packed(now, part, owners, numbers, parts)

    columns = schema(rows.schema["doc_id"].dataType)
    names, arrow = columns.names, to_arrow_schema(columns)
    place = F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id() % 4096)
    dealt = rows.select("doc_id", "text", F.pmod(F.xxhash64("doc_id", "text", place), F.lit(shards)).cast("int").alias("shard"))
    dealt = dealt.withColumn("__h", F.xxhash64("text"))  # ties of an id go by a hash of the text
    return dealt.repartition("shard").sortWithinPartitions("shard", F.col("doc_id").asc_nulls_first(), "__h").mapInArrow(run, columns)


def write_bins(packed: DataFrame, path: str) -> DataFrame:
    """Writes input_ids, position_ids and segment ends of each part of a shard as flat binary files below path (any file
    system that pyarrow knows by its URI), each under a temporary name that is then moved, so that a task that
    runs twice leaves whole files. Returns (shard, part, n_rows)."""

    def run(group: pa.Table) -> pa.Table:
        from uuid import uuid4

        from pyarrow import fs

        files, base = fs.FileSystem.from_uri(path)
        files.create_dir(base, recursive=True)
        group = group.sort_by("row")
        shard, part = group["shard"][0].as_py(), group["part"][0].as_py()
        ends = np.concatenate([np.asarray(x, np.int32) for x in group["cu_seqlens"].to_pylist()])
        for name, chunks in (("input_ids", group["input_ids"].to_pylist()), ("position_ids", group["position_ids"].to_pylist()), ("cu_seqlens", [ends.tobytes()])):
            to = f"{base}/{name}-{shard:05d}-{part:03d}.bin"
            temporary = f"{to}.{uuid4().hex}"
            with files.open_output_stream(temporary) as f:
                for x in chunks:
                    f.write(x)
            files.move(temporary, to)
        return pa.table({"shard": pa.array([shard], pa.int32()), "part": pa.array([part], pa.int32()), "n_rows": pa.array([len(group)], pa.int32())})

    return packed.groupBy("shard", "part").applyInArrow(run, "shard int, part int, n_rows int")
