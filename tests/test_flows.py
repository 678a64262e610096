import gzip
import hashlib
import json
import math

from pyspark.sql import functions as F

from lodestone.operators import generation as G
from lodestone.operators import metrics as M
from lodestone.plans import flows
from lodestone.sinks import writers as K
from lodestone.sources import files as Fs
from lodestone.sources import literals as L


def test_translation_batch(spark, tmp_path):
    h = hashlib.sha256(b"abc").hexdigest()
    entry = lambda s, t, a, f: {"sourceLanguage": s, "targetLanguage": t, "architecture": a, "files": {"model": {"path": f"p/{f}.gz", "uncompressedHash": h}}, "metrics": {"flores": {"comet22": 0.8525}}}
    (tmp_path / "reg.json").write_text(json.dumps({"baseUrl": "http://h", "models": {"en-nl": [entry("en", "nl", "base", "x"), entry("en", "nl", "tiny", "a.bin")], "nl-en": [entry("nl", "en", "base", "b.bin")], "en-es": [entry("en", "es", "tiny", "c.bin")]}}))
    (tmp_path / "req.json").write_text(json.dumps([[{"source_language": "en-US", "target_language": "nl"}, {"source_language": "nl", "target_language": "en"}], [{"source_language": "en", "target_language": "es"}, {"source_language": "en", "target_language": "xx"}]]))
    (tmp_path / "cat.json").write_text(json.dumps([[{"source_language": "nl", "target_language": "en", "bidirectional": True}], [{"source_language": "es", "target_language": "en", "bidirectional": True}, {"source_language": "fr", "target_language": "en"}]]))
    (tmp_path / "f").mkdir()
    (tmp_path / "f" / "a.bin.gz").write_bytes(gzip.compress(b"abc"))
    (tmp_path / "f" / "b.bin.gz").write_bytes(gzip.compress(b"other"))
    out = flows.translation_batch(spark, *(str(tmp_path / x) for x in ("req.json", "reg.json", "cat.json")), "v9", str(tmp_path / "f"))
    assert {(r.request, r.architecture) for r in out.resolved.collect()} == {("0:0", "tiny"), ("0:1", "base"), ("1:0", "tiny")}
    assert {tuple(r) for r in out.errors.collect()} == {("1:1", "no models for en-xx"), ("0:1", "hash b.bin"), ("1:0", "missing c.bin")}
    assert {tuple(r) for r in out.missing_reverse.collect()} == {("nl", "en-US"), ("en", "nl"), ("es", "en")}
    assert {(r.source_language, r.version, r.score) for r in out.catalog.collect()} == {("nl", "v9", 85.2), ("es", "v9", 85.2), ("fr", "v9", None)}


def test_pack_release(spark):
    specs = spark.createDataFrame([("detector", "tiny", "s", "", None), ("recognizer", "small", "s", "cj", None)], "kind string, tier string, stem string, script string, note string")
    old = spark.createDataFrame([("F_tiny_det_int8.mnn", 1, "old", "detector", None, 2, None, 0), ("kept", 1, "k", "x", None, 1, None, 1)], "name string, sizeBytes long, sha256 string, role string, script string, priority int, note string, pos int")
    files = spark.createDataFrame([("F_tiny_det_int8.mnn", 5, "a"), ("F_small_rec_int8.mnn", 6, "b"), ("F_small_keys.txt", 7, "c"), ("kept", 2, "k")], "name string, size long, sha256 string")
    manifest, checked = flows.pack_release(specs, old, files, "F", "stills", [])
    assert manifest.count() == 4 and manifest.filter("sha256 = 'old'").count() == 0
    assert {tuple(r) for r in checked.collect()} == {("F_tiny_det_int8.mnn", "ok"), ("F_small_rec_int8.mnn", "ok"), ("F_small_keys.txt", "ok"), ("kept", "size")}


def test_dataset_release(spark, tmp_path):
    lineage = flows.dataset_release(spark.range(17).toDF("id"), str(tmp_path / "d"), 12, 4, 5)
    rows = sorted((r["index"], r.shard, r.row) for r in lineage.collect())
    assert len(rows) == 16 and rows[7][1:] == ("train-00001-of-00003.parquet", 2) and rows[12] == (12, "validation-00000-of-00001.parquet", 0)
    assert spark.read.json(str(tmp_path / "d" / "lineage")).count() == 16


def test_evaluation(spark):
    labels = spark.createDataFrame([(1, [1.0] * 40, [0.5] * 40), (2, [0.0] * 40, [0.5] * 40)], "strip_id long, matte array<float>, weight array<float>")
    preds = spark.createDataFrame([("m", 1, [9.0] * 40, [0.0] * 40), ("m", 2, [-9.0] * 40, [0.0] * 40)], "model string, strip_id long, matte array<float>, weight array<float>")
    got = {r.metric: r.value for r in flows.evaluation(preds, labels).collect()}
    assert got["matte_iou"] == 0.5 and got["weight_mae"] == 0.0 and math.isclose(got["matte_iou_p5"], 0.05)


def test_generation_is_the_same_in_any_order(spark):
    make = lambda rng: {"x": rng.randint(0, 9)}
    a = G.generate(spark.range(40), make, lambda s: s["x"] > 6, "id long, x int, tries int, accepted boolean")
    b = G.generate(spark.range(39, -1, -1).repartition(3), make, lambda s: s["x"] > 6, "id long, x int, tries int, accepted boolean")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect())) and a.filter("accepted and x <= 6").count() == 0
    never = G.generate(spark.range(2), make, lambda s: False, "id long, x int, tries int, accepted boolean")
    assert [(r.tries, r.accepted) for r in never.collect()] == [(12, False)] * 2


def test_degradation(spark):
    p = F.array(*[F.lit(0.5)] * 4)
    r = spark.range(1).select(G.squeezed(F.array(F.lit(1.0), F.lit(0.0)), F.lit(0.5)), G.shadowed(p, F.lit(2), F.lit(1), F.lit(0.5)), G.shaded(p, F.lit(2), F.lit(1.0))).first()
    assert list(r[0]) == [0.75, 0.25] and list(r[1]) == [0.5, 0.25, 0.5, 0.25] and list(r[2]) == [0.25, 0.5, 0.25, 0.5]


def test_script_fallback(spark):
    words = spark.createDataFrame([("ar", "مرحبا"), ("ja", "日本"), ("zh_cn", "中")], "code string, word string")
    got = G.script_fallback(words, L.script_words(spark))
    by = {r.script: r.n for r in got.groupBy("script").agg(F.count("*").alias("n")).collect()}
    assert by == {"arabic": 1, "cjk": 2, "devanagari": 128, "tamil": 128, "thai": 128}
    assert got.filter("script = 'thai'").agg(F.min("word")).first()[0] == "฀"


def test_legible_strip(spark):
    cover = [1.0] * 40 + [0.0] * 60 + [0.0] * 100
    dark = lambda ink: [ink] * 40 + [0.9] * 160
    df = spark.createDataFrame([(1, cover, [dark(0.1)]), (2, cover, [dark(0.85)]), (3, [1.0] * 10 + [0.0] * 190, [dark(0.1)]), (4, [1.0] * 100 + [0.0] * 100, [dark(0.1)])], "id int, c array<double>, ch array<array<double>>")
    assert {r.id: r.ok for r in df.select("id", M.legible_strip(F.col("c"), F.col("ch"), F.lit(100), F.lit(40)).alias("ok")).collect()} == {1: True, 2: False, 3: False, 4: False}


def test_small_pieces(spark, tmp_path):
    df = spark.createDataFrame([([3, 4],), ([5],)], "shape array<int>")
    assert df.agg(M.parameter_count(F.col("shape")).alias("n")).first().n == 17
    (tmp_path / "version.txt").write_text("1.2.0\n")
    assert Fs.version(spark, str(tmp_path / "version.txt")).first().version == "1.2.0"
    to = K.write_versioned(df, str(tmp_path / "out"), "1")
    assert to.endswith("version=1") and spark.read.parquet(to).count() == 2
    Fs.register_udtf(spark)
    tar = K.tar_bundles(spark.createDataFrame([("b", "a", bytearray(b"xy"))], "bundle string, name string, content binary"))
    tar.createOrReplaceTempView("tars")
    assert [tuple(r) for r in spark.sql("SELECT t.member, t.size FROM tars, LATERAL tar_members(content) t").collect()] == [("a", 2)]
