import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lodestone.llm import packing
from lodestone.llm.bpe import coder

PATH = P.path("byte_bpe_50k.tiktoken")
DDL = "doc_id long, text string, n_tokens int, row string"


def brute(lengths, row):
    """Best fit decreasing by looking at every row."""
    rows, free = [], []
    for k in sorted(range(len(lengths)), key=lambda k: (-lengths[k], k)):
        fits = [(f, i) for i, f in enumerate(free) if f >= lengths[k]]
        if fits:
            f, i = min(fits)
            rows[i].append(k)
            free[i] -= lengths[k]
        else:
            rows.append([k])
            free.append(row - lengths[k])
    return rows, free


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=60))
def test_best_fit_decreasing(lengths):
    mine = packing.best_fit_decreasing(lengths, 64)
    theirs, free = brute(lengths, 64)
    assert sorted(k for r in mine for k in r) == list(range(len(lengths)))
    assert sorted(64 - sum(lengths[k] for k in r) for r in mine) == sorted(free)
    assert len(mine) == len(theirs)


def unpacked(rows, row):
    out = {}
    for r in rows:
        ids, places = np.frombuffer(r.input_ids, np.uint16), np.frombuffer(r.position_ids, np.uint16)
        assert len(ids) == len(places) == row and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens <= row
        for k, (doc, piece) in enumerate(zip(r.doc_ids, r.pieces)):
            a, b = r.cu_seqlens[k], r.cu_seqlens[k + 1]
            assert places[a:b].tolist() == list(range(b - a))
            out.setdefault(doc, []).append((piece, ids[a:b].tolist()))
    return out


def test_round_trip_of_odd_rows(spark):
    long_ = "the quick brown fox. " * 500
    data = [(1, "hello world", 0, "x"), (2, None, 0, "x"), (3, "", 0, None), (4, long_, 1, "y"), (None, "no id", 1, "y"), (5, "same", 1, "z"), (5, "same", 1, "z")]
    packed = packing.pack(spark.createDataFrame(data, DDL), PATH, P.PATTERN, row=128, shard_bytes=4000).collect()
    found = unpacked(packed, 128)
    bpe = coder(PATH, P.PATTERN)
    for doc, text in ((1, "hello world"), (2, ""), (3, ""), (4, long_), (None, "no id")):
        pieces = sorted(found[doc])
        assert [p for p, _ in pieces] == list(range(len(pieces)))
        assert [x for _, ids in pieces for x in ids] == [*bpe.encode(text), packing.END]
    assert len(found[5]) == 2


def test_same_whatever_the_partitions(spark):
    data = [(k, f"text number {k} " * (k % 17), 0, "") for k in range(200)]
    a = packing.pack(spark.createDataFrame(data, DDL).repartition(1), PATH, P.PATTERN, row=256, shard_bytes=5000).collect()
    b = packing.pack(spark.createDataFrame(data[::-1], DDL).repartition(7), PATH, P.PATTERN, row=256, shard_bytes=5000).collect()
    assert sorted(a) == sorted(b)


def test_parts_bound_what_a_task_holds(spark):
    data = [(7, "the same row again and again", 0, "")] * 300 + [(None, "no id", 0, "")] * 100
    packed = packing.pack(spark.createDataFrame(data, DDL), PATH, P.PATTERN, row=64, shard_bytes=500).collect()
    assert max(r.part for r in packed) >= 5 and sum(len(r.doc_ids) for r in packed) == 400
    assert len({(r.shard, r.part, r.row) for r in packed}) == len(packed)


def test_empty(spark):
    assert packing.pack(spark.createDataFrame([], DDL), PATH, P.PATTERN).count() == 0


def test_bins(spark, tmp_path):
    data = [(k, f"text number {k} " * (k % 17), 0, "") for k in range(50)]
    packed = packing.pack(spark.createDataFrame(data, DDL), PATH, P.PATTERN, row=64, shard_bytes=2000)
    n = {(r.shard, r.part): r.n_rows for r in packing.write_bins(packed, f"file://{tmp_path}/bins").collect()}
    rows = sorted(packed.collect(), key=lambda r: (r.shard, r.part, r.row))
    for (shard, part), count in n.items():
        ids = np.fromfile(tmp_path / "bins" / f"input_ids-{shard:05d}-{part:03d}.bin", np.uint16).reshape(count, 64)
        assert ids.tobytes() == b"".join(r.input_ids for r in rows if (r.shard, r.part) == (shard, part))
    assert len(list((tmp_path / "bins").iterdir())) == 3 * len(n)
    with pytest.raises(IndexError):
        packing.CapacityTree(4).put(0, 9)


def test_ids_keep_their_type(spark):
    df = spark.createDataFrame([("doc-a", "one two"), (None, "three"), ("doc-b", "one " * 50)], "doc_id string, text string")
    got = packing.pack(df, PATH, P.PATTERN, row=32)
    assert got.schema["doc_ids"].dataType.elementType.simpleString() == "string"
    assert {x for r in got.collect() for x in r.doc_ids} == {"doc-a", "doc-b", None}
