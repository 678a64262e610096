import base64
import gzip
import hashlib
import io

import pytest
from pyspark.sql import functions as F

from lodestone.llm import queries
from lodestone.llm import warc as W

DDL = "page_id long, url string, html string, payload string, record_type int"
PAGES = [(3, "http://a/1", "same"), (1, "http://b/2", "same"), (2, "http://b/\r\n3", "other é"), (4, None, None), (5, "u", ""), (None, "n", "same"), (6, "http://c/", "x" * 300_000), (6, "http://c/", "x" * 300_000)]


def frame(spark, rows=PAGES):
    return spark.createDataFrame([(*r, "p", 1) for r in rows], DDL)


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def written(spark, path, rows=PAGES, least=0):
    W.archive(frame(spark, rows), str(path), "page_id", "url", "html", "urn:p:", least)
    return W.read(spark, str(path))


def test_round_trip(spark, tmp_path):
    got = written(spark, tmp_path / "w").collect()
    assert len(got) == len(PAGES)
    by = {r.record_id: r for r in got}
    assert by["urn:p:1"].record_type == "response" and bytes(by["urn:p:1"].payload) == b"same"
    assert (by["urn:p:3"].record_type, by["urn:p:3"].refers_to, by["urn:p:3"].payload, by["urn:p:3"].payload_bytes) == ("revisit", "urn:p:1", None, 4)
    assert by["urn:p:2"].target_uri == "http://b/%0D%0A3" and bytes(by["urn:p:2"].payload).decode() == "other é"
    assert (by["urn:p:4"].record_type, by["urn:p:5"].record_type, by["urn:p:5"].refers_to) == ("response", "revisit", "urn:p:4")
    assert by["urn:p:4"].target_uri is None and by["urn:p:null"].record_type == "response"
    assert [r.record_type for r in got if r.record_id == "urn:p:6"] == ["response"] * 2
    assert all(r.payload_digest == digest(h) for r in got for i, _, h in PAGES if r.record_id == f"urn:p:{i}")


def test_small_payloads_are_all_responses(spark, tmp_path):
    assert {r.record_type for r in written(spark, tmp_path / "w", PAGES[:6], least=5).collect()} == {"response"}


def test_pushed_filters(spark, tmp_path):
    df = written(spark, tmp_path / "w")
    assert df.filter("record_type = 'revisit'").count() == 2
    assert df.filter(F.col("target_uri").startswith("http://b/")).count() == 2
    assert df.filter(F.col("record_id").isin("urn:p:1", "urn:p:2") & (F.col("record_type") == "response")).count() == 2
    assert {r.payload for r in W.read(spark, str(tmp_path / "w"), payload=False).select("payload").collect()} == {None}


def test_scans_of_one_table_keep_their_own_filters(spark, tmp_path):
    df = written(spark, tmp_path / "w")
    kind = lambda x: df.filter(F.col("record_type") == x)
    n = [df.count(), kind("revisit").count(), kind("response").count(), df.count()]
    assert n == [len(PAGES), 2, len(PAGES) - 2, len(PAGES)]
    both = kind("revisit").union(kind("response")).union(df.filter(F.col("record_id") == "urn:p:1")).collect()
    assert len(both) == len(PAGES) + 1 and sum(r.record_type == "revisit" for r in both) == 2
    assert kind("revisit").union(df).count() == len(PAGES) + 2


def test_unwanted_payloads_are_never_decoded_through_spark(spark, tmp_path):
    """Payloads that can't be inflated: only a reader that gets the predicate can read past them."""
    noise = __import__("random").Random(2).randbytes(60_000)
    whole = W.member(W.record("r", "response", "u", None, "D", len(noise), noise))
    broken = whole[:30_000] + bytes(20_000) + whole[50_000:]
    (tmp_path / "a.warc.gz").write_bytes(broken + W.member(W.record("v", "revisit", "u", "r", "D", 3, None)))
    read = lambda: W.read(spark, str(tmp_path))
    assert [r.record_id for r in read().filter("record_type = 'revisit'").collect()] == ["v"]
    assert [r.record_id for r in read().filter(F.col("record_id").isin("v", "w") & F.col("target_uri").startswith("u")).collect()] == ["v"]
    with pytest.raises(Exception, match="rror"):
        read().collect()


def test_every_cut_ends(spark):
    """A file that ends early gives whole records and then an error, or ends at a record's border."""
    plain = W.record("r", "response", "u", None, "D", 3, b"abc")
    for data, lone in ((plain, len(plain) - 4), (W.member(plain), len(W.member(plain))), (gzip.compress(plain), len(gzip.compress(plain)))):
        for n in range(1, len(data)):
            try:
                got = list(W.records(io.BytesIO(data[:n]), n, lambda c: True))
            except ValueError:
                continue
            assert n >= lone and len(got) == 1 and got[0][1].endswith(b"abc"), n


def test_copies_alone_are_shuffled(spark):
    """Payloads without a copy, and all copies but the first, cross no exchange."""
    rows = [(k, "u", f"page {k} " * 50) for k in range(40)] + [(100 + k, "u", "the same") for k in range(60)]
    got = W.planned(frame(spark, rows), "page_id", "url", "html", "").collect()
    assert sum(r.record_type == "revisit" for r in got) == 59 and len(got) == 100
    assert {r.refers_to for r in got if r.record_type == "revisit"} == {"100"} and all(r.payload is None for r in got if r.record_type == "revisit")
    assert bytes(next(r for r in got if r.record_id == "100").payload) == b"the same"


def test_payloads_without_a_copy_are_kept_where_the_filter_lets_them_through(spark):
    """With 300 copied payloads, the bit set lets some of 3000 others through."""
    rows = [(k, "u", f"page {k % 300}") for k in range(600)] + [(1000 + k, "u", f"alone {k}") for k in range(3000)]
    got = {r.record_id: r for r in W.planned(frame(spark, rows), "page_id", "url", "html", "").collect()}
    assert len(got) == len(rows)
    for k, _, html in rows:
        r, again = got[str(k)], 300 <= k < 600
        assert (r.record_type, r.refers_to) == (("revisit", str(k - 300)) if again else ("response", None))
        assert r.payload is None if again else bytes(r.payload).decode() == html


def test_query_on_rows_without_an_id(spark, tmp_path):
    rows = [(None, "u", "same"), (2, "u", "same"), (1, "u", "same"), (None, "u", "alone"), (3, "u", None), (None, None, "")]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    got = {tuple(r) for r in queries.op8_warc(spark, str(tmp_path)).collect()}
    kinds = [("revisit", 1), ("revisit", 1), ("response", None), ("response", None), ("response", None), ("revisit", 3)]
    assert got == {(k, len(html or ""), digest(html), *kind) for (k, _, html), kind in zip(rows, kinds, strict=True)}


class Counting(io.BytesIO):
    taken = 0

    def read(self, n=-1):
        out = super().read(n)
        Counting.taken += len(out)
        return out


def test_unwanted_payloads_are_skipped():
    rng = __import__("random").Random(1)
    big = bytes(rng.randrange(256) for _ in range(200_000))
    data = b"".join(W.member(W.record(f"r{k}", "response", "u", None, "D", len(big), big)) for k in range(5))
    Counting.taken = 0
    assert list(W.records(Counting(data), len(data), lambda c: False)) == [] and Counting.taken < 20_000
    got = list(W.records(io.BytesIO(data), len(data), lambda c: c["record_id"] == "r3"))
    assert len(got) == 1 and got[0][1].endswith(big)


def test_archives_of_other_writers():
    plain = b"".join(W.record(f"r{k}", "response", "u", None, "D", 3, b"abc") for k in range(3))
    assert [c["record_id"] for c, _ in W.records(io.BytesIO(plain), len(plain), lambda c: True)] == ["r0", "r1", "r2"]
    assert [c["record_id"] for c, _ in W.records(io.BytesIO(plain), len(plain), lambda c: c["record_id"] != "r1")] == ["r0", "r2"]
    packed = b"".join(gzip.compress(W.record(f"r{k}", "response", "u", None, "D", 5000, b"abcde" * 1000)) for k in range(3))
    got = list(W.records(io.BytesIO(packed), len(packed), lambda c: c["record_id"] != "r1"))
    assert [c["record_id"] for c, _ in got] == ["r0", "r2"] and all(b.endswith(b"abcde" * 1000) for _, b in got)
    own = W.member(W.record("r", "response", None, None, "D", 0, None))
    assert gzip.decompress(own) == W.record("r", "response", None, None, "D", 0, None)


def test_long_headers():
    data = W.member(W.record("r", "response", "http://x/" + "y" * 10_000, None, "D", 3, b"abc"))
    ((columns, block),) = W.records(io.BytesIO(data), len(data), lambda c: True)
    assert len(columns["target_uri"]) == 10_009 and block.endswith(b"abc")


def test_only_committed_files_are_read(spark, tmp_path):
    n = written(spark, tmp_path / "w").count()
    (tmp_path / "w" / "part-00000-left.warc.gz").write_bytes(W.member(W.record("z", "response", None, None, "D", 0, None)))
    assert W.read(spark, str(tmp_path / "w")).count() == n


def test_empty(spark, tmp_path):
    assert written(spark, tmp_path / "w", []).count() == 0


def test_many_records_in_one_member():
    plain = b"".join(W.record(f"r{k}", "response", "u", None, "D", 9000 * k, b"abc" * 3000 * k) for k in range(5))
    data = gzip.compress(plain) + gzip.compress(W.record("last", "response", "u", None, "D", 3, b"abc"))
    for skipped in ("r1", "r4", "none"):
        got = list(W.records(io.BytesIO(data), len(data), lambda c, skipped=skipped: c["record_id"] != skipped))
        assert [c["record_id"] for c, _ in got] == [x for x in ("r0", "r1", "r2", "r3", "r4", "last") if x != skipped]
        assert all(b.partition(b"\r\n\r\n")[2] == b"abc" * (int(c["payload_bytes"]) // 3) for c, b in got)


def test_broken_archives_raise():
    one = W.record("r", "response", "u", None, "D", 3, b"abc")
    for data in (one + b"WARC/1.1\r\nWARC-Type: response", one + one[:-6], gzip.compress(one + one[:40]), gzip.compress(one)[:-30], W.member(one)[:-30], gzip.compress(one + one[:-6])):
        with pytest.raises(ValueError):
            list(W.records(io.BytesIO(data), len(data), lambda c: True))
    assert len(list(W.records(io.BytesIO(one + b"\r\n"), len(one) + 2, lambda c: True))) == 1
