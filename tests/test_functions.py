import struct

import pytest
from pyspark.sql import functions as F

from lodestone.functions import arrays as A
from lodestone.functions import binary as B
from lodestone.functions import numbers as N
from lodestone.functions import text as X


def one(spark, *columns):
    return spark.range(1).select(*[c.alias(f"c{k}") for k, c in enumerate(columns)]).first()


def each(spark, f, cases):
    rows = spark.createDataFrame([(k, a) for k, (a, _) in enumerate(cases)], "k int, a string").select("k", f(F.col("a")).alias("b")).orderBy("k").collect()
    assert [r.b for r in rows] == [b for _, b in cases]


def test_normalize_language(spark):
    each(spark, X.normalize_language, [("zh", "zh"), ("zh-Hans", "zh"), ("zh-CN", "zh"), ("zh-Hant", "zh_hant"), ("zh_TW", "zh_hant"), ("zh-HK", "zh_hant"), ("en-US", "en"), ("pt-BR", "pt"), ("nb", "nb"), ("NB", "nb"), (None, None)])


def test_version(spark):
    each(spark, X.version, [("v1.12.14 2d067af 2024-02-16", "v1.12.14"), ("dev v1.2.3", "dev v1.2.3"), ("", ""), (None, None)])


def test_paths(spark):
    each(spark, X.stem, [("a/m.bin.gz", "m.bin"), ("m", "m"), (".x", ".x"), ("a.b/c", "c")])
    each(spark, lambda c: X.with_suffix(c, ".sha256"), [("x-bundle.tar.gz", "x-bundle.tar.sha256"), ("a.b/c", "a.b/c.sha256")])
    assert one(spark, X.url_join(F.lit("http://h/"), F.lit("/a/b")), X.url_parent(F.lit("http://h/a/b"))) == ("http://h/a/b", "http://h/a")


def test_names(spark):
    each(spark, X.voice_name, [("nl/nl_NL/mls/medium", "nl_NL-mls-medium"), ("nl/nl_NL/mls", "nl_NL-mls-medium")])
    with pytest.raises(Exception, match="not a voice path"):
        one(spark, X.voice_name(F.lit("nl/nl_NL")))
    each(spark, lambda c: X.bundle_id("whisper", c), [("small-q4_k", "whisper.small"), ("small.en", "whisper.small.en")])
    assert one(spark, X.shard_name(F.lit("train"), F.lit(1), F.lit(3)))[0] == "train-00001-of-00003.parquet"


def test_booleans(spark):
    each(spark, X.to_boolean, [("Yes", True), ("T", True), ("1", True), ("no", False), ("f", False), ("0", False)])
    with pytest.raises(Exception, match="not a boolean"):
        one(spark, X.to_boolean(F.lit("maybe")))


def test_strip_and_title(spark):
    each(spark, X.strip, [(" a b \n", "a b"), ("", "")])
    each(spark, X.title, [("they're x-ray", "They'Re X-Ray"), ("ÉCOLE 2a", "École 2A")])
    each(spark, X.without_marks, [("é", "e")])


def test_punctuation(spark):
    p = lambda r, cjk: X.punctuated(F.lit("a b"), F.lit(r), F.lit(cjk))
    got = one(spark, p(0.1, True), p(0.2, True), p(0.25, True), p(0.1, False), p(0.4, False), p(0.5, False), p(0.58, False), p(0.9, False))
    assert list(got) == ["a b。", "「a b」", "a b、", "a b.", "a b,", '"a b"', "a-b", "a b"]


def test_numbers(spark):
    got = one(spark, N.score_100(F.lit(0.8525)), N.score_100(F.lit(0.8853)), N.weight_target(F.lit(0.075)), N.weight_target(F.lit(0.06)))
    assert got[0] == 85.2 and got[1] == 88.5 and got[2] == 0.5 and abs(got[3] - 0.13296424) < 1e-8
    assert list(one(spark, N.padding(F.lit(320)), N.padding(F.lit(321)), N.padding(F.lit(504)))) == [0, 15, 8]
    assert one(spark, N.l2(F.lit(3.0), F.lit(4.0)), N.sigmoid(F.lit(-100.0))) == (5.0, pytest.approx(9.357622968839299e-14))


def test_arrays(spark):
    a = F.array(*[F.lit(float(x)) for x in (5, 1, 4, 2)])
    got = one(spark, A.smallest(a, 2), A.median(a), A.stride_sample(a, 2), A.padded(a, F.lit(5), F.lit(0.0)), A.transpose(F.array(a, a), 2))
    assert [list(got[0]), got[1], list(got[2]), list(got[3])] == [[1, 2], 3.0, [5, 4], [5, 1, 4, 2, 0]]
    assert [list(x) for x in got[4]] == [[5, 5], [1, 1]]
    assert one(spark, A.first_of_each(F.create_map(F.lit("a"), F.array(F.lit(3), F.lit(4)))))[0] == {"a": 3}


def test_bytes(spark):
    import gzip

    got = one(spark, F.hex(B.vocabulary_entry(F.lit("é"), F.lit(258))), B.little_endian(F.lit(4294967295).cast("long")))
    assert got[0] == "C3A90002010000" and bytes(got[1]) == struct.pack("<I", 4294967295)
    df = spark.createDataFrame([(bytearray(gzip.compress(b"abc")),), (None,)], "c binary")
    assert [r[0] for r in df.select(B.inflate("c")).collect()] == [b"abc", None]
    m = spark.createDataFrame([([2.0, 1.0, 1.0, 3.0], [3.0, 5.0])], "m array<double>, r array<double>")
    assert m.select(B.solve("m", "r")).first()[0] == pytest.approx([0.8, 1.4])


def test_png(spark):
    raw = bytes(range(24))
    df = spark.createDataFrame([(bytearray(raw), 4, 2, 3)], "raw binary, w int, h int, c int")
    assert bytes(df.select(B.decode_png(B.encode_png("raw", "w", "h", "c"))).first()[0]) == raw


def test_uniform_is_the_same_everywhere(spark):
    import hashlib

    assert one(spark, N.uniform(F.lit(7), "s"))[0] == int(hashlib.sha256(b"7s").hexdigest()[:8], 16) / 2**32


def test_scores_are_rounded_on_the_binary_value(spark):
    """As round() does, for all scores of four digits, and for other numbers and digits."""
    import random

    from lodestone.functions import numbers as N

    df = spark.range(10_001).selectExpr("id / 10000.0D AS x")
    assert [r for r in df.select("x", N.score_100(F.col("x")).alias("y")).collect() if r.y != round(r.x * 100, 1)] == []
    rng = random.Random(2)
    xs = [rng.uniform(-1000, 1000) for _ in range(3000)] + [k / 8 for k in range(-200, 200)] + [0.0, 2.5, 1e15 + 0.3, 1e17, -1e300, 5e-324]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    for digits in (0, 1, 2, 4):
        assert [r for r in df.select("x", N.rounded(F.col("x"), digits).alias("y")).collect() if r.y != round(r.x, digits)] == []


def test_png_filters():
    """All five filters of a row, undone pixel by pixel."""
    import random
    import struct
    import zlib

    from lodestone.functions import binary as B

    rng, width, height = random.Random(1), 9, 25
    for channels, color in ((1, 0), (3, 2), (4, 6)):
        stride = width * channels
        raw = bytes(rng.randrange(256) for _ in range(stride * height))
        lines, above = b"", bytes(stride)
        for y in range(height):
            line, kind = raw[y * stride : (y + 1) * stride], y % 5
            lines += bytes([kind])
            for x in range(stride):
                a, b, c = (line[x - channels] if x >= channels else 0), above[x], (above[x - channels] if x >= channels else 0)
                p = a + b - c
                paeth = min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c))[2]
                lines += bytes([(line[x] - (0, a, b, (a + b) // 2, paeth)[kind]) & 255])
            above = line
        chunk = lambda k, d: struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))
        data = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, color, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(lines)) + chunk(b"IEND", b"")
        assert B.png_pixels(data) == raw
