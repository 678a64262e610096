"""Queries for sources and sinks: documents and files of the reference's shapes are written to the shared folder from
the standard tables, and read back by the readers. They go when the application ends."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestone.functions import arrays as A
from lodestone.functions import binary as B
from lodestone.functions import numbers as N
from lodestone.functions import text as X
from lodestone.operators import dataset as D
from lodestone.operators import export as E
from lodestone.operators import generation as G
from lodestone.operators import integrity as I
from lodestone.operators import metrics as M
from lodestone.operators import registry as R
from lodestone.plans import flows
from lodestone.plans.registered import query, table
from lodestone.session import scratch
from lodestone.sinks import writers as K
from lodestone.sources import documents as S
from lodestone.sources import files as Fs
from lodestone.sources import literals as L

# Documents


def _registry(spark, sf_dir):
    """A registry document for each nation: its suppliers are the entries of its pair."""
    s = table(spark, sf_dir, "supplier").withColumn("n", F.concat(F.lit("n"), F.col("s_nationkey").cast("string")))
    file = F.struct(F.concat(F.lit("/m/"), "s_suppkey", F.lit(".gz")).alias("path"), F.sha2(F.col("s_name").cast("binary"), 256).alias("uncompressedHash"))
    kind = F.element_at(F.array(F.lit("base"), F.lit("tiny"), F.lit("base-memory"), F.lit("other")), (F.col("s_suppkey") % 4 + 1).cast("int"))
    score = F.create_map(F.lit("flores"), F.create_map(F.lit("comet22"), F.expr("(s_suppkey * 7919 % 10001) / 10000")))
    entry = F.struct("s_suppkey", F.struct(F.col("n").alias("sourceLanguage"), F.lit("en").alias("targetLanguage"), kind.alias("architecture"), F.create_map(F.lit("model"), file).alias("files"), score.alias("metrics")).alias("e"))
    by_key = lambda a, b: F.sign(a["s_suppkey"] - b["s_suppkey"]).cast("int")
    models = s.groupBy("n").agg(F.transform(F.array_sort(F.collect_list(entry), by_key), lambda x: x["e"]).alias("e"))
    docs = models.select("n", K.document(F.lit("http://h/").alias("baseUrl"), F.create_map(F.concat("n", F.lit("-en")), "e").alias("models")).alias("value"))
    K.write_each(docs, to := scratch(spark, "registry"), "n")
    return S.registry(spark, to)


@query("""SELECT 'http://h/' AS base_url, 'n' || s_nationkey || '-en' AS pair, CAST(row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) - 1 AS INTEGER) AS pos,
 CASE s_suppkey % 4 WHEN 0 THEN 'base' WHEN 1 THEN 'tiny' WHEN 2 THEN 'base-memory' ELSE 'other' END AS architecture, (s_suppkey * 7919 % 10001) / 10000 AS score FROM supplier""")
def registry_entries(spark, sf_dir):
    return _registry(spark, sf_dir).select("base_url", "pair", "pos", "architecture", F.col("metrics")["flores"]["comet22"].alias("score"))


@query("""SELECT 'n' || s_nationkey || '-en' AS pair, 'model' AS kind, 'http://h/m/' || s_suppkey || '.gz' AS url, sha256(s_name) AS hash FROM supplier""")
def registry_file_rows(spark, sf_dir):
    rows = S.registry_files(_registry(spark, sf_dir))
    return rows.select("pair", "kind", X.url_join(F.col("base_url"), F.col("path")).alias("url"), "hash")


@query("""WITH e AS (SELECT 'n' || s_nationkey || '-en' AS pair, CAST(row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) - 1 AS INTEGER) AS pos FROM supplier)
SELECT n_nationkey, coalesce(CASE WHEN n_nationkey % 7 = 6 THEN NULL ELSE pos END, -1) AS pos FROM nation LEFT JOIN e ON pair = CASE WHEN n_nationkey % 7 = 6 THEN 'none' ELSE 'n' || n_nationkey || '-en' END""")
def pair_entries(spark, sf_dir):
    """The default lookup: all entries of a pair, none for an unknown one."""
    n = F.col("n_nationkey")
    source = F.when(n % 7 == 6, F.lit("none")).otherwise(F.concat(F.lit("N"), n.cast("string"), F.lit("-XX")))
    asked = table(spark, sf_dir, "nation").select("n_nationkey", source.alias("source_language"), F.lit("en").alias("target_language"))
    return R.pair_lookup(asked, _registry(spark, sf_dir)).select("n_nationkey", F.coalesce("pos", F.lit(-1)).alias("pos"))


@query("SELECT n_nationkey, CAST(n_regionkey + 1 AS INTEGER) AS encoder_depth, CASE WHEN n_nationkey % 2 = 0 THEN 2 END AS decoder_depth, CASE WHEN n_nationkey % 3 = 0 THEN 'v1.' || n_regionkey || '.0' ELSE 'dev' END AS version FROM nation")
def model_config_rows(spark, sf_dir):
    n = F.col("n_nationkey")
    version = F.when(n % 3 == 0, F.concat(F.lit("v1."), F.col("n_regionkey").cast("string"), F.lit(".0 abc"))).otherwise(F.lit("dev"))
    config = F.struct((F.col("n_regionkey") + 1).alias("enc-depth"), F.when(n % 2 == 0, F.lit(2)).alias("dec-depth"), version.alias("version"))
    K.write_each(table(spark, sf_dir, "nation").select("n_nationkey", K.document(config.alias("modelConfig")).alias("value")), to := scratch(spark, "configs"), "n_nationkey")
    found = S.model_configs(spark, to)
    return found.select(F.regexp_extract("url", "n_nationkey=([0-9]+)$", 1).cast("int").alias("n_nationkey"), "encoder_depth", "decoder_depth", "version")


def _grouped(rows, key: str, per_group: int, groups: int, fields: list):
    """(doc, value): documents that are lists of lists, of rows in the order of a key."""
    doc, group = F.expr(f"{key} div {per_group * groups}"), F.expr(f"{key} % {per_group * groups} div {per_group}")
    entries = F.transform(F.array_sort(F.collect_list(F.struct(F.col(key).alias("__key"), F.struct(*fields).alias("__e")))), lambda x: x["__e"])
    one = rows.groupBy(doc.alias("doc"), group.alias("g")).agg(entries.alias("e"))
    lists = F.transform(F.array_sort(F.collect_list(F.struct("g", "e"))), lambda x: x["e"])
    return one.groupBy("doc").agg(F.to_json(lists).alias("value"))


@query("""SELECT CAST(c_custkey % 50 // 10 AS INTEGER) AS "group", CAST(c_custkey % 10 AS INTEGER) AS pos, 'n' || c_nationkey AS source_language, c_mktsegment AS target_language, CASE WHEN c_custkey % 3 = 1 THEN 'tiny' END AS architecture, CASE WHEN c_custkey % 2 = 0 THEN c_acctbal END AS score FROM customer""")
def batch_request_rows(spark, sf_dir):
    k = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer")
    fields = [F.concat(F.lit("n"), "c_nationkey").alias("source_language"), F.col("c_mktsegment").alias("target_language"), F.when(k % 3 == 0, F.lit("")).when(k % 3 == 1, F.lit("tiny")).alias("architecture"), F.when(k % 2 == 0, F.col("c_acctbal")).alias("score")]
    K.write_each(_grouped(rows, "c_custkey", 10, 5, fields), to := scratch(spark, "request"), "doc")
    return S.batch_request(spark, to)


@query("""SELECT CAST(c_custkey % 50 // 10 AS INTEGER) AS "group", CAST(c_custkey % 10 AS INTEGER) AS pos, c_name AS source_language, c_custkey % 2 = 0 AS bidirectional, c_custkey AS size, 'a,b' AS architectures FROM customer""")
def catalog_rows(spark, sf_dir):
    fields = [F.col("c_name").alias("source_language"), (F.col("c_custkey") % 2 == 0).alias("bidirectional"), F.col("c_custkey").alias("size"), F.array(F.lit("a"), F.lit("b")).alias("architectures")]
    K.write_each(_grouped(table(spark, sf_dir, "customer"), "c_custkey", 10, 5, fields), to := scratch(spark, "catalog"), "doc")
    return S.catalog(spark, to).select("group", "pos", "source_language", "bidirectional", "size", F.array_join("architectures", ",").alias("architectures"))


@query("""SELECT CAST(c_custkey % 50 // 10 AS INTEGER) AS "group", CAST(c_custkey % 10 AS INTEGER) AS pos, c_name AS checksum, c_custkey AS size FROM customer""")
def generated_rows(spark, sf_dir):
    """Half of the documents are {version, models}, the others bare lists."""
    docs = _grouped(table(spark, sf_dir, "customer"), "c_custkey", 10, 5, [F.col("c_name").alias("checksum"), F.col("c_custkey").alias("size")])
    value = F.when(F.col("doc") % 2 == 0, F.concat(F.lit('{"version":"v1","models":'), "value", F.lit("}"))).otherwise(F.col("value"))
    K.write_each(docs.withColumn("value", value), to := scratch(spark, "generated"), "doc")
    return S.generated(spark, to).select("group", "pos", "checksum", "size")


@query("SELECT n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN 'd' || n_nationkey ELSE 'n_nationkey=' || n_nationkey END AS directory, n_name AS source_language, CASE WHEN n_nationkey % 3 = 0 THEN n_regionkey / 4 END AS score, n_name || '.bin' AS model FROM nation")
def bundle_metadata_rows(spark, sf_dir):
    n = F.col("n_nationkey")
    fields = [F.when(n % 2 == 0, F.concat(F.lit("d"), n.cast("string"))).otherwise(F.lit("")).alias("directory"), F.col("n_name").alias("source_language"), F.when(n % 3 == 0, F.col("n_regionkey") / 4).alias("score"), F.struct(F.concat("n_name", F.lit(".bin")).alias("model")).alias("files")]
    K.write_each(table(spark, sf_dir, "nation").select("n_nationkey", K.document(*fields).alias("value")), to := scratch(spark, "metadata"), "n_nationkey")
    return S.bundle_metadata(spark, to).select("n_nationkey", X.name(F.col("directory")).alias("directory"), "source_language", "score", F.col("files.model").alias("model"))


@query("SELECT 'v' || (p_partkey // 40) AS version, CAST(p_partkey % 40 AS INTEGER) AS pos, p_name AS name, p_partkey AS sizeBytes, CASE WHEN p_size > 25 THEN 'detector' END AS role, p_size AS priority FROM part")
def manifest_entries(spark, sf_dir):
    file = F.struct(F.col("p_partkey").alias("sizeBytes"), F.col("p_name").alias("name"), F.when(F.col("p_size") > 25, F.lit("detector")).alias("role"), F.col("p_size").alias("priority"))
    docs = table(spark, sf_dir, "part").groupBy(F.expr("p_partkey div 40").alias("doc")).agg(F.array_sort(F.collect_list(file)).alias("files"))
    K.write_each(docs.select("doc", K.document(F.concat(F.lit("v"), "doc").alias("version"), F.lit("p").alias("pack"), "files").alias("value")), to := scratch(spark, "manifest"), "doc")
    return S.manifest(spark, to).select("version", "pos", "name", "sizeBytes", "role", "priority")


@query("SELECT s_name AS id, s_suppkey AS size, 'en,n' || s_nationkey AS languages, CASE WHEN s_suppkey % 2 = 0 THEN 'f' END AS gender FROM supplier")
def flat_catalog_rows(spark, sf_dir):
    voices = F.when(F.col("s_suppkey") % 2 == 0, F.array(F.struct(F.lit("f").alias("gender"), F.lit("en").alias("language"))))
    entry = F.struct(F.col("s_name").alias("id"), F.col("s_suppkey").alias("size"), F.array(F.lit("en"), F.concat(F.lit("n"), "s_nationkey")).alias("languages"), voices.alias("voices"))
    docs = table(spark, sf_dir, "supplier").groupBy(F.expr("s_suppkey div 25").alias("doc")).agg(F.to_json(F.collect_list(entry)).alias("value"))
    K.write_each(docs, to := scratch(spark, "flat"), "doc")
    return S.flat_catalog(spark, to).select("id", "size", F.array_join("languages", ",").alias("languages"), F.get("voices", F.lit(0))["gender"].alias("gender"))


@query("SELECT n_name AS phoneme, n_nationkey AS id FROM nation")
def phoneme_rows(spark, sf_dir):
    docs = table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.map_from_entries(F.collect_list(F.struct("n_name", F.array("n_nationkey", F.lit(99))))).alias("phoneme_id_map"))
    K.write_each(docs.select("n_regionkey", K.document("phoneme_id_map").alias("value")), to := scratch(spark, "phonemes"), "n_regionkey")
    return S.phonemes(spark, to)


@query("SELECT CAST(row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1 AS INTEGER) AS pos, n_name AS value FROM nation")
def yaml_items(spark, sf_dir):
    quoted = F.when(F.col("n_nationkey") % 3 == 0, F.concat(F.lit("'"), "n_name", F.lit("'"))).when(F.col("n_nationkey") % 3 == 1, F.concat(F.lit('"'), "n_name", F.lit('"'))).otherwise(F.col("n_name"))
    lines = F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", quoted.alias("q")))), lambda x: F.concat(F.lit("\n  - "), x["q"]))
    docs = table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.concat(F.lit("kind: x\nkeys:"), F.array_join(lines, ""), F.lit("\n")).alias("value"))
    K.write_each(docs, to := scratch(spark, "yaml"), "n_regionkey")
    return S.yaml_list(spark, to, "keys")


@query("SELECT CAST(row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1 AS INTEGER) AS line, n_name AS value FROM nation")
def word_list_lines(spark, sf_dir):
    lines = F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))), lambda x: x["n_name"])
    K.write_each(table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.array_join(lines, "\r\n").alias("value")), to := scratch(spark, "words"), "n_regionkey")
    return Fs.words(spark, to).select("line", "value")


@query("SELECT r_name AS version FROM region")
def version_files(spark, sf_dir):
    K.write_each(table(spark, sf_dir, "region").select("r_regionkey", F.concat(F.lit(" "), "r_name", F.lit(" \n")).alias("value")), to := scratch(spark, "version"), "r_regionkey")
    return Fs.version(spark, to)


# Files


@query("SELECT 'c' || c_nationkey AS name, string_agg(c_name, ' ' ORDER BY c_custkey) AS content, sha256(string_agg(c_name, ' ' ORDER BY c_custkey)) AS sha256 FROM customer GROUP BY c_nationkey")
def inflated_files(spark, sf_dir):
    names = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("c_custkey", "c_name"))), lambda x: x["c_name"]), " ")
    rows = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(names.alias("t"))
    K.write_files(rows.select(F.concat(F.lit("c"), "c_nationkey", F.lit(".gz")).alias("name"), B.deflate(F.col("t").cast("binary")).alias("content")), to := scratch(spark, "gzip")).count()
    return Fs.inflated(spark, to).select("name", F.col("content").cast("string").alias("content"), "sha256")


def _bundles(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda x: F.coalesce(x["text"], F.lit(""))), "\n").alias("t"))
    files = rows.select(F.concat(F.lit("b"), F.expr("conv_id div 50")).alias("bundle"), F.concat(F.lit("m/"), "conv_id", F.lit(".txt")).alias("name"), F.col("t").cast("binary").alias("content"))
    K.write_files(K.tar_bundles(files).select(F.concat("bundle", F.lit(".tar.gz")).alias("name"), "content"), to := scratch(spark, "bundles")).count()
    return to


MEMBERS = "SELECT conv_id, string_agg(coalesce(text, ''), chr(10) ORDER BY turn) AS t FROM conversations GROUP BY conv_id"


@query(f"SELECT 'b' || (conv_id // 50) || '.tar.gz' AS archive, 'm/' || conv_id || '.txt' AS member, CAST(octet_length(encode(t)) AS BIGINT) AS size, sha256(t) AS sha256 FROM ({MEMBERS})")
def bundle_members(spark, sf_dir):
    return Fs.tar_members(spark, _bundles(spark, sf_dir)).select(X.name(F.col("archive")).alias("archive"), "member", "size", F.sha2("content", 256).alias("sha256"))


@query("SELECT DISTINCT 'b' || (conv_id // 50) || '.tar.gz' AS name, true AS sized, true AS hashed FROM conversations")
def file_listing(spark, sf_dir):
    to = _bundles(spark, sf_dir)
    sizes = Fs.listing(spark, to).select("name", F.col("size").alias("n"))
    return Fs.hashed(spark, to).join(sizes, "name").select("name", (F.col("size") == F.col("n")).alias("sized"), (F.length("sha256") == 64).alias("hashed"))


SHARDS = "SELECT doc_id, lang, i AS index, printf('train-%05d-of-%05d.parquet', CAST(i // 300 AS INTEGER), CAST(greatest(1, (n + 299) // 300) AS INTEGER)) AS shard, CAST(i % 300 AS INTEGER) AS row FROM (SELECT doc_id, lang, row_number() OVER (ORDER BY doc_id) - 1 AS i, count(*) OVER () AS n FROM documents)"


@query(f"SELECT index, shard FROM ({SHARDS})")
def shard_scan(spark, sf_dir):
    """Shards written by number and read again, two columns of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    rows = D.shards(D.numbered(docs, "doc_id"), docs.count(), 300)
    K.write_shards(rows, to := scratch(spark, "shards"))
    return Fs.shards(spark, to, ["index", "shard"])


@query("SELECT doc_id, lang, i AS index, CASE WHEN i < n - 30 THEN printf('train-%05d-of-%05d.parquet', CAST(i // 300 AS INTEGER), CAST((n - 30 + 299) // 300 AS INTEGER)) ELSE 'validation-00000-of-00001.parquet' END AS shard, CAST(CASE WHEN i < n - 30 THEN i % 300 ELSE i - (n - 30) END AS INTEGER) AS row FROM (SELECT doc_id, lang, row_number() OVER (ORDER BY doc_id) - 1 AS i, count(*) OVER () AS n FROM documents)")
def dataset_lineage(spark, sf_dir):
    """A whole release, read back from its lineage file."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    n = docs.count() - 30
    flows.dataset_release(docs, to := scratch(spark, "release"), n, 30, 300, "doc_id")
    return spark.read.schema("doc_id long, lang string, index long, shard string, row int").json(f"{to}/lineage")


@query("SELECT r_name AS value FROM region")
def key_lines(spark, sf_dir):
    keys = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("pos"), F.col("r_name").alias("value"))
    n = K.write_keys(keys, to := scratch(spark, "keys"))
    return spark.read.text(to).filter(F.lit(n) > 0)


@query("SELECT r_regionkey, r_name FROM region")
def versioned_copy(spark, sf_dir):
    """A second version beside the first, which stays."""
    to, region = scratch(spark, "versions"), table(spark, sf_dir, "region")
    K.write_versioned(region.limit(0), f"{to}/t", "1")
    return spark.read.schema(region.schema).parquet(K.write_versioned(region, f"{to}/t", "2"))


@query("SELECT lower(string_agg(hex(encode(n_name)) || '00' || lpad(hex(n_nationkey), 2, '0') || '000000', '' ORDER BY n_nationkey)) AS value FROM nation")
def vocabulary_file(spark, sf_dir):
    return K.vocabulary(table(spark, sf_dir, "nation"), "n_name", "n_nationkey").select(F.lower(F.hex("value")).alias("value"))


# Smaller operators that work on values


@query("""WITH RECURSIVE n AS (SELECT p_partkey AS k, p_partkey // 5 AS g, p_name AS name, p_brand AS op, CASE WHEN p_partkey % 5 < 2 THEN p_partkey // 5 * 2 + 1 + p_partkey % 5 END AS sub FROM part WHERE p_brand <> 'Brand#3'),
r AS (SELECT k, name, op, sub FROM n WHERE g = 0 UNION ALL SELECT n.k, n.name, n.op, n.sub FROM n JOIN r ON n.g = r.sub) SELECT name, op FROM r""")
def nested_operators(spark, sf_dir):
    """Parts as nodes of graphs, five in each, the first two with a graph inside."""
    k = F.col("p_partkey")
    graph = F.expr("p_partkey div 5")
    nodes = table(spark, sf_dir, "part").select(graph.cast("string").alias("graph"), F.col("p_name").alias("name"), F.col("p_brand").alias("op"), F.when(k % 5 < 2, graph * 2 + 1 + k % 5).cast("string").alias("subgraph"))
    known = [f"Brand#{x}" for x in range(100)]
    return E.operators(nodes, "0", known, ["Brand#3"])


@query("SELECT CAST(NULL AS VARCHAR) AS error WHERE false")
def strict_names(spark, sf_dir):
    """An assertion that holds: no row, and no error."""
    bad = I.absent(table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("k")), table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k")), "k")
    return I.strict(bad, F.concat(F.lit("unknown nation "), F.col("k").cast("string"))).select(F.col("error").cast("string").alias("error"))


@query("""WITH p AS (SELECT vec_id, label, i, CAST(embedding[i + 1] AS DOUBLE) AS v, i // 8 AS r FROM embeddings, range(64) AS t(i)),
q AS (SELECT *, count(*) FILTER (v > 0) OVER (PARTITION BY vec_id, r) > 0 AS inked FROM p),
s AS (SELECT vec_id, label, count(*) FILTER (v > 0) AS n, count(*) FILTER (v <= 0 AND inked) AS m, median(v) FILTER (v > 0) AS a, median(v) FILTER (v <= 0 AND inked) AS b FROM q GROUP BY vec_id, label)
SELECT vec_id, n >= 30 AND m >= 30 AND abs(a - b) > 0.13 + 0.006 * greatest(0, 30 - (label % 3 * 20)) AS ok FROM s""")
def legible_strips(spark, sf_dir):
    """Vectors as strips of eight by eight, inked where they are positive."""
    e = F.transform("embedding", lambda x: x.cast("double"))
    cover = F.transform(e, lambda x: F.when(x > 0, F.lit(1.0)).otherwise(F.lit(0.0)))
    ok = M.legible_strip(cover, F.array(e), F.lit(8), F.col("label") % 3 * 20)
    return table(spark, sf_dir, "embeddings").select("vec_id", ok.alias("ok"))


@query("""WITH p AS (SELECT vec_id, i, CAST(embedding[i + 1] AS DOUBLE) AS v FROM embeddings, range(64) AS t(i))
SELECT vec_id, round(CASE WHEN count(*) FILTER (v > 0) < 20 THEN 0.0 ELSE least(2 * avg(v) FILTER (v > 0) / greatest(max(i // 8) FILTER (v > 0) - min(i // 8) FILTER (v > 0) + 1, 1), 0.45) END, 9) AS ratio FROM p GROUP BY vec_id""")
def stroke_of_masks(spark, sf_dir):
    e = F.transform("embedding", lambda x: x.cast("double"))
    cover = F.transform(e, lambda x: F.when(x > 0, F.lit(1.0)).otherwise(F.lit(0.0)))
    return table(spark, sf_dir, "embeddings").select("vec_id", F.round(M.stroke_of(cover, e, F.lit(8)), 9).alias("ratio"))


@query("SELECT doc_id, row_number() OVER (ORDER BY sha256(doc_id || ':7'), doc_id) - 1 AS place FROM documents")
def shuffled_rows(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id").withColumn("h", D.shuffle_key("doc_id", 7))
    return D.numbered(docs, "h", "doc_id").select("doc_id", F.col("index").alias("place"))


@query("SELECT event_id, CAST(floor(value) AS INTEGER) AS whole, CAST(user_id AS VARCHAR) AS text, CAST(user_id AS DOUBLE) AS real, TRY_CAST(event_type AS BIGINT) AS none, CAST(event_id % 2 AS BOOLEAN) AS odd FROM events")
def casts(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.floor("value").cast("int").alias("whole"), F.col("user_id").cast("string").alias("text"), F.col("user_id").cast("double").alias("real"), F.col("event_type").try_cast("long").alias("none"), (F.col("event_id") % 2).cast("boolean").alias("odd"))


@query("SELECT vec_id, true AS solved FROM embeddings")
def solved_systems(spark, sf_dir):
    """Eight unknowns from each vector as a matrix (its diagonal raised), and whether the solution solves it."""
    e = F.transform("embedding", lambda x, i: x.cast("double") + F.when(i % 9 == 0, F.lit(10.0)).otherwise(F.lit(0.0)))
    right = F.slice(e, 1, 8)
    rows = table(spark, sf_dir, "embeddings").select("vec_id", e.alias("m"), right.alias("b")).withColumn("x", B.solve("m", "b"))
    row = lambda k: F.slice(F.col("m"), k * 8 + 1, F.lit(8))
    dot = lambda k: F.aggregate(F.zip_with(row(k), F.col("x"), lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
    off = F.exists(F.transform(F.sequence(F.lit(0), F.lit(7)), lambda k: F.abs(dot(k) - F.get("b", k))), lambda d: d > 1e-9)
    return rows.select("vec_id", (~off).alias("solved"))


@query("SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS corner, CAST(embedding[9] AS DOUBLE) AS below, 70 AS padded, 10 AS cropped, 128 AS stacked FROM embeddings")
def array_shapes(spark, sf_dir):
    e = F.col("embedding")
    matrix = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda k: F.slice(e, k * 8 + 1, F.lit(8)))
    t = A.transpose(matrix, 8)
    size = lambda x, name: F.size(x).alias(name)
    return table(spark, sf_dir, "embeddings").select("vec_id", t[0][0].cast("double").alias("corner"), t[0][1].cast("double").alias("below"), size(A.padded(e, F.lit(70), F.lit(0).cast("float")), "padded"), size(A.cropped(e, F.lit(10)), "cropped"), size(A.stacked(e, e), "stacked"))


@query("""SELECT event_id, '{"a":"' || event_type || '","m":"' || user_id || '","z":"1"}' AS config FROM events""")
def metrics_folded(spark, sf_dir):
    s = lambda x: F.col(x).cast("string")
    config = F.create_map(F.lit("a"), s("event_type"), F.lit("m"), F.lit("old"))
    return table(spark, sf_dir, "events").select("event_id", F.to_json(E.with_metrics(config, F.create_map(F.lit("m"), s("user_id"), F.lit("z"), F.lit("1")))).alias("config"))


@query("SELECT doc_id, sha256(coalesce(text, '')) AS pixels FROM documents")
def png_pixels(spark, sf_dir):
    """Digests as pictures of eight by four pixels, there and back."""
    raw = F.unhex(B.digest(F.coalesce("text", F.lit(""))))
    there = B.encode_png(raw, F.lit(8), F.lit(4), F.lit(1))
    return table(spark, sf_dir, "documents").select("doc_id", F.lower(F.hex(B.decode_png(there))).alias("pixels"))


@query("SELECT page_id, url FROM pages")
def guarded_paths(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", X.guarded_dir(F.col("url"), ["/never-there/"]).alias("url"))


@query("SELECT n_nationkey, n_name || '-v' || n_regionkey || '-' || CASE WHEN n_nationkey % 2 = 0 THEN 'high' ELSE 'medium' END AS voice, 'app.' || n_name AS bundle FROM nation")
def built_names(spark, sf_dir):
    path = F.concat(F.lit("x/"), "n_name", F.lit("/v"), F.col("n_regionkey").cast("string"), F.when(F.col("n_nationkey") % 2 == 0, F.lit("/high")).otherwise(F.lit("")))
    return table(spark, sf_dir, "nation").select("n_nationkey", X.voice_name(path).alias("voice"), X.bundle_id("app", F.concat("n_name", F.lit("-int8"))).alias("bundle"))


@query("SELECT l_returnflag AS k, round(avg(l_discount) * 2 + avg(l_tax), 9) AS loss FROM lineitem GROUP BY 1")
def combined_losses(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_returnflag").alias("k")).agg(F.round(M.combined_loss({"a": F.avg("l_discount"), "b": F.avg("l_tax")}, {"a": 2.0}), 9).alias("loss"))


U = "CAST('0x' || substr(sha256(doc_id || '{}'), 1, 8) AS BIGINT) / 4294967296.0"
INK = "CASE WHEN {} < 0.08 THEN {} * 0.5 + 0.5 ELSE {} * 0.45 END"


@query(f"""SELECT doc_id, CAST(12 + floor({U.format('height')} * 33) AS INTEGER) AS native_h, CASE WHEN {U.format('stroke')} < 0.86 THEN 0 WHEN {U.format('stroke')} < 0.96 THEN 1 ELSE 2 END AS stroke_w, CAST(96 + 16 * floor({U.format('width')} * 27) AS INTEGER) AS width,
 CAST(floor({U.format('font')} * 40) AS INTEGER) AS font, round({INK.format(U.format('light'), U.format('ink r'), U.format('ink r'))} + {INK.format(U.format('light'), U.format('ink b'), U.format('ink b'))}, 9) AS ink, round(CASE WHEN {U.format('bright')} < 0.5 THEN 0.6 + 0.4 * {U.format('paper g')} ELSE {U.format('paper g')} END, 9) AS paper FROM documents""")
def sample_choices(spark, sf_dir):
    ids = table(spark, sf_dir, "documents").select("doc_id")
    out = D.sample_parameters(ids, L.script_weights(spark), "doc_id")
    return out.select("doc_id", "native_h", "stroke_w", "width", "font", F.round(F.col("ink")[0] + F.col("ink")[2], 9).alias("ink"), F.round(F.col("paper")[1], 9).alias("paper"))


@query("""WITH p AS (SELECT vec_id, i, CAST(embedding[i + 1] AS DOUBLE) AS v FROM embeddings, range(64) AS t(i))
SELECT vec_id, round(sum(0.5 + (v - 0.5) * 0.5), 9) AS squeezed, round(sum(CASE WHEN i % 8 >= 4 THEN v * 0.75 ELSE v END), 9) AS shadowed, round(sum(least(greatest(v * (1 + 0.5 * (i % 8 / 8 - 0.5)), 0), 1)), 9) AS shaded FROM p GROUP BY vec_id""")
def degraded_strips(spark, sf_dir):
    e = F.col("embedding")
    total = lambda x, name: F.round(A.total(x), 9).alias(name)
    return table(spark, sf_dir, "embeddings").select("vec_id", total(G.squeezed(e, F.lit(0.5)), "squeezed"), total(G.shadowed(e, F.lit(8), F.lit(4), F.lit(0.25)), "shadowed"), total(G.shaded(e, F.lit(8), F.lit(0.5)), "shaded"))


@query(None)
def generated_samples(spark, sf_dir):
    """Made anew until accepted, each from a generator of its own id: no SQL has Python's random numbers."""
    ids = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"))
    return G.generate(ids, lambda rng: {"x": rng.randint(0, 9)}, lambda s: s["x"] > 3, "id long, x int, tries int, accepted boolean")


@query("SELECT doc_id, round(r, 9) AS r, uniform AS same FROM (SELECT doc_id, " + U.format("a") + " AS r, true AS uniform FROM documents)")
def salted_uniform(spark, sf_dir):
    r = N.uniform(F.col("doc_id"), "a")
    return table(spark, sf_dir, "documents").select("doc_id", F.round(r, 9).alias("r"), (r == N.uniform(F.col("doc_id"), "a")).alias("same"))
