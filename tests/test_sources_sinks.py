import gzip
import io
import json
import tarfile

from pyspark.sql import functions as F

from lodestone.operators import integrity as I
from lodestone.sinks import writers as K
from lodestone.sources import documents as S
from lodestone.sources import files as Fs


def test_registry(spark, tmp_path):
    doc = {"baseUrl": "http://h", "models": {"en-nl": [{"sourceLanguage": "en", "targetLanguage": "nl", "architecture": "tiny", "files": {"model": {"path": "p/m.bin.gz", "uncompressedHash": "ab"}}, "metrics": {"flores": {"comet22": 0.9}}}]}}
    (tmp_path / "r.json").write_text(json.dumps(doc))
    e = S.registry(spark, str(tmp_path / "r.json"))
    assert [(r.pair, r.pos, r.architecture) for r in e.collect()] == [("en-nl", 0, "tiny")]
    assert [(r.kind, r.path, r.hash) for r in S.registry_files(e).collect()] == [("model", "p/m.bin.gz", "ab")]
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "m.json").write_text('{"modelConfig": {"enc-depth": 6, "version": "v1.2.3 x"}}')
    c = S.model_configs(spark, str(tmp_path / "c")).first()
    assert (c.encoder_depth, c.decoder_depth, c.version) == (6, None, "v1.2.3")
    joined = S.with_model_config(e, S.model_configs(spark, str(tmp_path / "c")).withColumn("url", F.lit("http://h/p")))
    assert joined.first().encoder_depth == 6


def test_groups(spark, tmp_path):
    (tmp_path / "b.json").write_text('[[{"source_language": "en", "target_language": "nl", "architecture": ""}], [{"source_language": "a", "target_language": "b", "score": 0.5}, {"source_language": "b", "target_language": "a"}]]')
    got = S.batch_request(spark, str(tmp_path / "b.json")).orderBy("group", "pos").collect()
    assert [(r.group, r.pos, r.source_language, r.architecture, r.score) for r in got] == [(0, 0, "en", None, None), (1, 0, "a", None, 0.5), (1, 1, "b", None, None)]
    assert S.catalog(spark, str(tmp_path / "b.json")).count() == 3
    (tmp_path / "g.json").write_text('{"version": "v", "models": [[{"source_language": "en", "size": 5}]]}')
    assert S.generated(spark, str(tmp_path / "g.json")).first().size == 5 and S.generated(spark, str(tmp_path / "b.json")).count() == 3


def test_catalogs_and_metadata(spark, tmp_path):
    (tmp_path / "f.json").write_text('[{"id": "a", "size": 3, "languages": ["en"], "voices": [{"gender": "f", "language": "en"}]}]')
    assert S.flat_catalog(spark, str(tmp_path / "f.json")).first().voices[0].gender == "f"
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "metadata.json").write_text('{"source_language": "en", "score": 0.0, "files": {"model": "m.bin"}}')
    m = S.bundle_metadata(spark, str(tmp_path / "m" / "metadata.json"))
    assert m.first().directory.endswith("/m") and I.required(m, "score", "version").first().missing == "version"


def test_manifest_round_trip(spark, tmp_path):
    (tmp_path / "pack").mkdir()
    (tmp_path / "pack" / "a.bin").write_bytes(b"abc")
    files = Fs.hashed(spark, str(tmp_path / "pack"))
    doc = files.agg(F.lit("v1").alias("version"), F.lit("p").alias("pack"), F.collect_list(F.struct("name", F.col("size").alias("sizeBytes"), "sha256")).alias("files")).select(K.document("version", "pack", "files").alias("value"))
    K.write_documents(doc, str(tmp_path / "manifest"))
    m = S.manifest(spark, str(tmp_path / "manifest"))
    assert [r.status for r in I.verify_pack(m, files).collect()] == ["ok"]
    assert Fs.listing(spark, str(tmp_path / "pack")).first()["size"] == 3
    side = K.sidecars(spark.createDataFrame([("x.tar.gz", bytearray(b"abc"))], "path string, content binary")).first()
    assert side.path == "x.tar.sha256" and side.value.startswith("ba7816bf")


def test_gzip_and_tar(spark, tmp_path):
    (tmp_path / "m.bin.gz").write_bytes(gzip.compress(b"abc"))
    r = Fs.inflated(spark, str(tmp_path)).first()
    assert (r.name, bytes(r.content)) == ("m.bin", b"abc")
    bundle = K.tar_bundles(spark.createDataFrame([("b", "z", bytearray(b"1")), ("b", "a", bytearray(b"2"))], "bundle string, name string, content binary")).first()
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "b.tar.gz").write_bytes(bytes(bundle.content))
    assert [(x.member, bytes(x.content)) for x in Fs.tar_members(spark, str(tmp_path / "t")).collect()] == [("a", b"2"), ("z", b"1")]
    bad = io.BytesIO()
    with tarfile.open(fileobj=bad, mode="w") as t:
        t.addfile(tarfile.TarInfo("../x"))
    (tmp_path / "u").mkdir()
    (tmp_path / "u" / "b.tar").write_bytes(bad.getvalue())
    assert Fs.tar_members(spark, str(tmp_path / "u")).count() == 0


def test_words_keys_yaml(spark, tmp_path):
    (tmp_path / "w.txt").write_text("b 5\r\na 3\n\n")
    assert [(r.line, r.value) for r in Fs.words(spark, str(tmp_path / "w.txt")).collect()] == [(0, "b 5"), (1, "a 3")]
    (tmp_path / "k.yml").write_text("x: 1\nkeys:\n  - 'a'\n  - \"b\"\n  - c\n")
    keys = S.yaml_list(spark, str(tmp_path / "k.yml"), "keys")
    assert K.write_keys(keys, str(tmp_path / "keys")) == 3
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "keys")).collect()) == ["a", "b", "c"]
    (tmp_path / "p.json").write_text('{"phoneme_id_map": {"a": [3, 4], "b": [5]}}')
    assert sorted(tuple(r) for r in S.phonemes(spark, str(tmp_path / "p.json")).collect()) == [("a", 3), ("b", 5)]


def test_shards_lineage_catalog(spark, tmp_path):
    df = spark.createDataFrame([(0, "s0", "a"), (1, "s0", None), (2, "s1", "c")], "index int, shard string, text string")
    K.write_shards(df, str(tmp_path / "shards"))
    assert Fs.shards(spark, str(tmp_path / "shards"), ["index"]).count() == 3
    K.write_lineage(df, str(tmp_path / "lineage"))
    assert spark.read.json(str(tmp_path / "lineage")).count() == 3
    rows = spark.createDataFrame([(0, 1, "b", "p", 2), (0, 0, "a", "q", 1), (1, 0, "c", "r", 3)], "group int, pos int, source string, path string, size int")
    got = {r.group: json.loads(r.value) for r in K.catalog_groups(rows, ["source", "path", "size"]).collect()}
    assert got[0] == [{"source": "a", "path": "q", "size": 1, "bidirectional": True}, {"source": "b", "path": "q", "size": 1, "bidirectional": True}]
    v = K.vocabulary(spark.createDataFrame([("b", 2), ("a", 1)], "token string, id int")).first().value
    assert bytes(v) == b"a\0\x01\0\0\0b\0\x02\0\0\0"
    m = K.bundle_members(spark.createDataFrame([("x/b",), ("y/a",)], "name string"), "root")
    assert [r.member for r in m.collect()] == ["root/a", "root/b"]
