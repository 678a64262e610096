import math

import pytest
from pyspark.sql import functions as F

from lodestone.operators import dataset as D
from lodestone.operators import export as E
from lodestone.operators import integrity as I
from lodestone.operators import metrics as M
from lodestone.operators import registry as R
from lodestone.sources import literals as L


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_preference(spark):
    e = spark.createDataFrame([("a", "base", 0), ("a", "tiny", 1), ("b", "base", 0), ("b", "base-memory", 1), ("c", "x", 0), ("c", "y", 1), ("d", None, 5)], "pair string, architecture string, pos int")
    assert rows(R.preferred(e, ["pair"]).select("pair", "architecture")) == [("a", "tiny"), ("b", "base-memory"), ("c", "x"), ("d", None)]


def test_resolve(spark):
    e = spark.createDataFrame([("en-nl", "base", 0), ("en-nl", "tiny", 1)], "pair string, architecture string, pos int")
    q = spark.createDataFrame([(1, "en-US", "nl", None), (2, "en", "nl", "base"), (3, "en", "nl", "big"), (4, "en", "xx", "big"), (5, "en", "xx", None)], "request int, source_language string, target_language string, architecture string")
    got = {r.request: r for r in R.resolve(q, e).collect()}
    assert '"tiny"' in got[1].entry and '"base"' in got[2].entry and got[1].error is None
    assert got[3].error.endswith("available: base, tiny") and got[4].error.endswith("available: none") and got[5].error == "no models for en-xx"


def test_catalog_merge(spark):
    ddl = "pos int, source_language string, target_language string, bidirectional boolean, version string, size long, score double"
    c = spark.createDataFrame([(0, "es", "en", True, "v0", 1, None), (1, "es", "en", False, "v0", 1, None), (2, "zh-CN", "en", None, "v0", 1, None)], ddl)
    g = spark.createDataFrame([(0, "en", "es", 5, 0.1), (1, "en", "es", 9, 0.8525), (2, "zh", "en", None, 0.5)], "pos int, source_language string, target_language string, size long, score double")
    got = {r.pos: r for r in R.catalog_merge(c, g, "v2").collect()}
    assert (got[0].size, got[0].score, got[0].version) == (9, 85.2, "v2")
    assert (got[1].size, got[1].score, got[1].version) == (1, None, "v2")
    assert (got[2].size, got[2].score) == (1, 50.0)
    assert {r.version for r in R.catalog_merge(c, g, "v2", matched_only=True).collect()} == {"v0", "v2"}


def test_point_update(spark):
    c = spark.createDataFrame([("a", 0, 1), ("a", 1, 1), ("b", 2, 1)], "id string, pos int, size int")
    assert rows(R.point_update(c, "a", {"size": F.lit(7)})) == [("a", 0, 7), ("a", 1, 1), ("b", 2, 1)]
    with pytest.raises(Exception, match="no entry z"):
        R.point_update(c, "z", {"size": F.lit(7)}).collect()


def test_verify_pack(spark):
    m = spark.createDataFrame([("a", 1, "x"), ("b", 2, "x"), ("c", 1, "y"), ("d", 1, "x")], "name string, sizeBytes long, sha256 string")
    f = spark.createDataFrame([("b", 1, "x"), ("c", 1, "x"), ("d", 1, "x"), ("e", 1, "x")], "name string, size long, sha256 string")
    assert rows(I.verify_pack(m, f)) == [("a", "missing"), ("b", "size"), ("c", "hash"), ("d", "ok")]
    with pytest.raises(Exception, match="bad a"):
        I.strict(I.verify_pack(m, f).filter("status = 'missing'"), F.concat(F.lit("bad "), "name")).collect()


def test_upsert(spark):
    old = spark.createDataFrame([("a", 0, 1), ("b", 1, 1)], "name string, pos int, size int")
    new = spark.createDataFrame([("a", 0, 2), ("a", 1, 3)], "name string, pos int, size int")
    assert [tuple(r) for r in I.upsert(old, new).orderBy("part", "pos").select("name", "size").collect()] == [("b", 1), ("a", 3)]


def test_pairs(spark):
    p = lambda x: spark.createDataFrame(x, "source string, target string")
    assert rows(I.missing_reverse(p([("en", "es"), ("es", "en")]))) == []
    three = p([("en", "es"), ("es", "en"), ("en", "nl")])
    assert rows(I.missing_reverse(three)) == [("nl", "en")]
    assert rows(I.missing_reverse(p([("a", "b"), ("a", "b"), ("x", "x")]))) == [("b", "a"), ("b", "a")]
    assert I.languages(three).first().languages == ["en", "es", "nl"]
    assert I.pair_report(three).first().missing == "nl-en"


def test_required(spark):
    df = spark.createDataFrame([(1, 0.0, ""), (2, None, "x"), (3, None, None)], "k int, score double, version string")
    assert rows(I.required(df, "score", "version").select("k", "missing")) == [(2, "score"), (3, "score, version")]


def test_pins_and_absence(spark):
    a = spark.createDataFrame([("x", "1"), ("y", "1"), ("z", "1")], "dest string, sha256 string")
    p = spark.createDataFrame([("x", "1"), ("y", "2")], "dest string, sha256 string")
    assert rows(I.compare_pins(a, p).select("dest", "ok")) == [("x", True), ("y", False), ("z", True)]
    assert rows(I.absent(a.select("dest"), p, "dest")) == [("z",)]
    n = spark.createDataFrame([(None,), ("q",)], "dest string")
    assert rows(I.absent(n, spark.createDataFrame([(None,)], "dest string"), "dest")) == [("q",)]


def test_language_set(spark):
    df = spark.createDataFrame([("small.en",), ("base-q8_0",)], "v string")
    assert [r[0] for r in df.select(I.language_set(F.col("v"), ["en", "nl"])).collect()] == [["en"], ["en", "nl"]]


def test_export(spark):
    s = spark.createDataFrame([("detector", "tiny", "s", "", None), ("recognizer", "small", "s", "cj", None), ("aligner", "", "doc", "", "n")], "kind string, tier string, stem string, script string, note string")
    got = rows(E.manifest_rows(E.with_variants(s, ["half", "quarter"]), "F", "stills only").select("name", "role", "script", "priority", "note"))
    assert ("F_tiny_det_quarter_int8.mnn", "detector", None, 3, "stills only") in got and ("F_small_keys.txt", "keys", "cj", 1, None) in got
    assert ("F_tiny_det_int8.mnn", "detector", None, 2, None) in got and ("doc_int8.mnn", "aligner", None, 1, "n") in got and len(got) == 6
    with pytest.raises(Exception, match="unknown kind"):
        spark.range(1).select(E.artifact_name(F.lit("x"), F.lit(""), F.lit(""), F.lit(""), "F")).collect()


def test_nested_nodes(spark):
    n = spark.createDataFrame([("main", "a", "If", "then"), ("main", "b", "Conv", None), ("then", "c", "If", "deep"), ("deep", "d", "Conv", None), ("other", "e", "Conv", None)], "graph string, name string, op string, subgraph string")
    assert sorted(r.name for r in E.nested_nodes(n, "main").collect()) == ["a", "b", "c", "d"]
    assert sorted(r.name for r in n.filter(~E.excluded(F.col("name"), ["a", "e"])).collect()) == ["b", "c", "d"]


def test_token_filters(spark):
    df = spark.createDataFrame([(x,) for x in ["ab", "a", "abcdefghijklm", "Don't", "don't", "USA", " ab "]], "w string")
    assert [r.w for r in df.filter(D.keep_token(F.col("w"))).collect()] == ["ab", "don't", "USA", " ab "]
    s = spark.createDataFrame([("مرحبا 12",), ("مرabc 3",), ("م 1",)], "w string")
    assert [r.w for r in s.filter(D.keep_script(F.col("w"), L.BLOCKS["ar"])).collect()] == ["مرحبا 12"]


def test_shards(spark):
    df = D.shards(D.numbered(spark.range(12).toDF("id"), "id"), 12, 5)
    r = df.filter("id = 7").first()
    assert (r.shard_no, r.row, r.shard) == (1, 2, "train-00001-of-00003.parquet")
    assert sorted(x["index"] for x in df.collect()) == list(range(12))
    v = D.shards(D.numbered(spark.range(3).toDF("id"), "id"), 3, 5, "validation", 12).orderBy("id").first()
    assert (v["index"], v.shard) == (12, "validation-00000-of-00001.parquet")


def test_inverse_cdf(spark):
    df = spark.createDataFrame([(0.49,), (0.5,), (0.95,)], "r double")
    assert [r.script for r in D.inverse_cdf(df, L.script_weights(spark)).orderBy("r").collect()] == ["latin", "cjk", "thai"]


def test_workers(spark):
    s = spark.createDataFrame([(0,), (1,), (2,)], "index int")
    assert rows(D.workers(s, 2).select("worker", "index")) == [(0, 0), (0, 2), (1, 1)]
    assert rows(D.workers(s.filter("index = 0"), 2).select("worker", "index")) == [(0, 0), (1, 0)]


def test_batches(spark):
    df = spark.createDataFrame([(k, 96) for k in range(5)] + [(k, 112) for k in range(5, 7)], "id int, width int")
    assert rows(D.batches(df, "width", "id", 2).groupBy("width", "batch").count()) == [(112, 0, 2), (96, 0, 2), (96, 1, 2)]
    assert D.replayed(df, 3).count() == 21


def test_sample_parameters(spark):
    df = D.sample_parameters(spark.range(200), L.script_weights(spark))
    r = df.agg(F.min("native_h"), F.max("native_h"), F.min("width"), F.max("width"), F.count("script")).first()
    assert 12 <= r[0] and r[1] <= 44 and r[2] >= 96 and r[3] <= 512 and r[4] == 200


def test_metrics(spark):
    mask = lambda *x: F.array(*[F.lit(bool(v)) for v in x])
    got = spark.range(1).select(M.iou(mask(1, 0), mask(0, 1)), M.iou(mask(1, 1), mask(1, 1)), M.iou(mask(0, 0), mask(0, 0))).first()
    assert list(got) == [0.0, 1.0, 0.0]
    a = F.array_repeat(F.lit(1.0), 30)
    got = spark.range(1).select(M.masked_mae(a, F.array_repeat(F.lit(3.0), 30), F.array_repeat(F.lit(True), 30)), M.masked_mae(a, a, F.array_repeat(F.lit(False), 30))).first()
    assert got[0] == 2.0 and math.isnan(got[1])


def test_auc_against_all_pairs(spark):
    import random

    random.seed(2)
    data = [(k % 3, random.choice([0.1, 0.3, 0.5, 0.9]), random.choice([0.0, 0.2, 0.4, 0.8])) for k in range(90)] + [(9, 0.1, 0.5), (9, 0.2, 0.5)]
    got = {r.k: r.auc for r in M.pairwise_auc(spark.createDataFrame(data, "k int, t double, p double"), ["k"], "t", "p").collect()}
    for k in range(3):
        own = [(t, p) for g, t, p in data if g == k]
        w = [1.0 if p > q else 0.5 if p == q else 0.0 for t, p in own for u, q in own if t - u > 0.25]
        assert got[k] == pytest.approx(sum(w) / len(w))
    assert math.isnan(got[9])


def test_summary_skips_nan(spark):
    df = spark.createDataFrame([("m", float("nan")), ("m", 1.0), ("m", 3.0)], "m string, v double")
    r = M.summary(df, ["m"], "v").first()
    assert (r.mean, r["max"]) == (2.0, 3.0) and r.p5 == pytest.approx(1.1)


def test_contrast(spark):
    c = lambda v: F.array_repeat(F.lit(v), 30)
    got = spark.range(1).select(M.legible(F.array(c(0.1)), F.array(c(0.9)), F.lit(40)), M.legible(F.array(c(0.4)), F.array(c(0.5)), F.lit(40)), M.legible(F.array(F.array(F.lit(0.1))), F.array(c(0.9)), F.lit(40))).first()
    assert list(got) == [True, False, False]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "pair string, architecture string, pos int")
    assert R.preferred(none, ["pair"]).count() == 0
    assert D.numbered(spark.range(0), "id").count() == 0
    assert I.languages(spark.createDataFrame([], "source string, target string")).first().n == 0


def test_numbers_of_many_rows_with_other_columns(spark, tmp_path):
    """Exactly 0 to n-1 in order, also over several files and partitions, with columns besides the order."""
    n = 1_500_000
    spark.range(0, n, 1, 16).selectExpr("id * 7919 % 1500000 AS k", "concat('text ', id) AS payload", "id % 13 AS c").write.parquet(str(tmp_path / "t"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "24")
    try:
        got = D.numbered(spark.read.parquet(str(tmp_path / "t")), "k")
        got.write.parquet(str(tmp_path / "out"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.agg(F.count("*"), F.count_distinct("index"), F.min("index"), F.max("index")).first() == (n, n, 0, n - 1)
    assert out.filter("index <> k").count() == 0 and set(out.columns) == {"k", "payload", "c", "index"}


def test_numbers_of_equal_keys(spark):
    df = spark.range(10_000).select(F.lit(1).alias("k"), F.col("id").alias("other"))
    a, b = (sorted((r["index"], r.other) for r in D.numbered(df.repartition(x), "k").collect()) for x in (3, 7))
    assert [x for x, _ in a] == list(range(10_000)) and a == b


def test_running_sums(spark):
    df = spark.range(5000).selectExpr("id % 3 AS g", "id AS k", "id % 7 AS v").unionByName(spark.range(5).selectExpr("CAST(NULL AS BIGINT) AS g", "id AS k", "1L AS v"))
    plain, ranges = ({(r.g, r.k): r.s for r in D.running(df, ["g"], ["k"], F.col("v"), "s", few).collect()} for few in (10**6, 10))
    assert plain == ranges and len(plain) == 5005 and plain[None, 4] == 4 and plain[0, 9] == 0 + 3 + 6


def test_batches_by_ranges(spark, monkeypatch):
    df = spark.range(1000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 96 ELSE 112 END AS width")
    want = rows(D.batches(df, "width", "id", 8))
    monkeypatch.setattr(D.running, "__defaults__", (5,))
    assert rows(D.batches(df, "width", "id", 8)) == want and len(want) == 334 // 8 * 8 + 666 // 8 * 8


def test_auc_against_all_pairs(spark, monkeypatch):
    import random

    rng = random.Random(4)
    data = [(rng.choice(["a", "b", None]), rng.choice([0.0, 0.1, 0.3, 0.55, 0.8, rng.random()]), round(rng.random(), 1)) for _ in range(300)] + [("c", 0.5, 1.0), ("d", None, 1.0)]
    df = spark.createDataFrame(data, "k string, t double, p double")
    for few in (10**6, 20):
        monkeypatch.setattr(D.running, "__defaults__", (few,))
        got = {r.k: r.auc for r in M.pairwise_auc(df, ["k"], "t", "p").collect()}
        for key in ("a", "b", None):
            pairs = [(x[2], y[2]) for x in data for y in data if x[0] == y[0] == key and x[1] - 0.25 > y[1]]
            assert math.isclose(got[key], sum(1.0 if p > q else 0.5 if p == q else 0.0 for p, q in pairs) / len(pairs))
        assert math.isnan(got["c"]) and math.isnan(got["d"])


def test_auc_of_very_many_scores(spark):
    """A million scores and forty labels: the score is the label and noise that no pair notices."""
    df = spark.range(1_000_000).selectExpr("1 AS k", "id % 40 / 40.0D AS t", "id % 40 / 40.0D + id / 1e10 AS p")
    assert M.pairwise_auc(df, ["k"], "t", "p").first().auc == 1.0


def test_operators_of_inner_graphs(spark):
    n = spark.createDataFrame([("main", "a", "Conv", None), ("main", "b", "If", "x"), ("main", "c", "Loop", "y"), ("x", "d", "Conv", None), ("y", "e", "Conv", None), ("it's", "f", "Conv", None)], "graph string, name string, op string, subgraph string")
    assert sorted(r.name for r in E.operators(n, "main", ["Conv", "If", "Loop"], ["Loop"]).collect()) == ["a", "b", "d"]
    assert [r.name for r in E.operators(n, "it's", ["Conv"], []).collect()] == ["f"]
    assert E.nested_nodes(n, "none").count() == 0


def test_kinds_named_after_their_stem(spark):
    df = spark.createDataFrame([("aligner", "s"), ("glyphmatte", "g")], "kind string, stem string")
    got = df.select(E.artifact_name(F.col("kind"), F.lit("t"), F.col("stem"), F.lit(""), "F").alias("n")).collect()
    assert [r.n for r in got] == ["s_int8.mnn", "g_int8.mnn"]


def test_stroke_of_a_mask(spark):
    """A bar of ten by four places in a strip of twenty by six."""
    cover = [1.0 if 1 <= y < 5 and 3 <= x < 13 else 0.0 for y in range(6) for x in range(20)]
    dist = [min(y, 5 - y) * 0.5 * c for y, c in zip([k // 20 for k in range(120)], cover)]
    ink = [d for d, c in zip(dist, cover) if c > 0.5]
    df = spark.createDataFrame([(cover, dist), ([0.0] * 120, dist)], "c array<double>, d array<double>")
    got = [r.s for r in df.select(M.stroke_of(F.col("c"), F.col("d"), F.lit(20)).alias("s")).collect()]
    assert math.isclose(got[0], min(0.45, 2 * sum(ink) / len(ink) / 4)) and got[1] == 0.0
