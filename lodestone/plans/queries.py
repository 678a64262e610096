"""Every operator as a query over the standard tables, next to the SQL for the same rows.

The tables hold no models or strips, so each operator works on a stand-in of the same shape."""

from __future__ import annotations

from pyspark.sql import DataFrame
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
from lodestone.plans.registered import ORACLE, QUERIES, query, table  # noqa: F401
from lodestone.sinks import writers as K
from lodestone.sources import literals as L

# Area A: registry and catalog

VARIANTS = "CASE CAST(doc_id AS BIGINT) % 4 WHEN 0 THEN 'base' WHEN 1 THEN 'tiny' WHEN 2 THEN 'base-memory' ELSE 'other' END"


def entries(docs: DataFrame) -> DataFrame:
    """Registry entries: a pair of source and language, an architecture and a place in the list."""
    kind = F.element_at(F.array(*[F.lit(x) for x in ("base", "tiny", "base-memory", "other")]), (F.col("doc_id") % 4 + 1).cast("int"))
    return docs.select(F.concat_ws("-", "source", "lang").alias("pair"), kind.alias("architecture"), F.col("doc_id").alias("pos"))


@query(f"""WITH e AS (SELECT source || '-' || lang AS pair, {VARIANTS} AS architecture, doc_id AS pos FROM documents WHERE source IS NOT NULL AND lang IS NOT NULL)
SELECT pair, architecture, pos FROM (SELECT *, row_number() OVER (PARTITION BY pair ORDER BY CASE architecture WHEN 'tiny' THEN 1 WHEN 'base-memory' THEN 2 WHEN 'base' THEN 3 ELSE 4 END, pos) AS n FROM e) WHERE n = 1""")
def preferred_variant(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").filter("source is not null and lang is not null")
    return R.preferred(entries(docs), ["pair"])


@query("""WITH c AS (SELECT DISTINCT c_nationkey, c_mktsegment FROM customer),
r AS (SELECT n_nationkey AS request, n_nationkey AS k, CASE n_nationkey % 3 WHEN 0 THEN 'BUILDING' WHEN 1 THEN 'NONE' END AS asked FROM nation),
m AS (SELECT r.request, r.asked, c.c_mktsegment AS found FROM r LEFT JOIN c ON c.c_nationkey = r.k)
SELECT request, min(CASE WHEN asked IS NULL OR asked = found THEN found END) AS architecture,
 CASE WHEN min(CASE WHEN asked IS NULL OR asked = found THEN found END) IS NULL THEN CASE WHEN asked IS NULL THEN 'no models for ' || request || '-' || request ELSE 'no ' || asked || ' model for ' || request || '-' || request || '; available: ' || coalesce(string_agg(found, ', ' ORDER BY found), 'none') END END AS error
FROM m GROUP BY request, asked""")
def pair_lookup(spark, sf_dir):
    found = table(spark, sf_dir, "customer").select("c_nationkey", "c_mktsegment").distinct()
    key = F.col("c_nationkey").cast("string")
    known = found.select(F.concat_ws("-", key, key).alias("pair"), F.col("c_mktsegment").alias("architecture"), F.col("c_mktsegment").alias("pos"))
    k = F.col("n_nationkey").cast("string")
    asked = F.when(F.col("n_nationkey") % 3 == 0, "BUILDING").when(F.col("n_nationkey") % 3 == 1, "NONE")
    requests = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("request"), k.alias("source_language"), k.alias("target_language"), asked.alias("architecture"))
    return R.resolve(requests, known).select("request", F.get_json_object("entry", "$.architecture").alias("architecture"), "error")


PAIRS = """SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS source, CAST(l_suppkey AS VARCHAR) AS target FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_custkey <> l_suppkey"""


def pairs(spark, sf_dir) -> DataFrame:
    """Directed pairs: customers and the suppliers that they buy from."""
    o, li = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    met = o.join(li, F.col("l_orderkey") == F.col("o_orderkey")).filter("o_custkey <> l_suppkey")
    return met.select(F.col("o_custkey").cast("string").alias("source"), F.col("l_suppkey").cast("string").alias("target")).distinct()


@query(f"WITH p AS ({PAIRS}) SELECT target AS source, source AS target FROM p WHERE NOT EXISTS (SELECT 1 FROM p AS q WHERE q.source = p.target AND q.target = p.source)")
def reverse_pair_missing(spark, sf_dir):
    return I.missing_reverse(pairs(spark, sf_dir))


@query(f"WITH p AS ({PAIRS}), u AS (SELECT source AS l FROM p UNION SELECT target FROM p) SELECT string_agg(l, ',' ORDER BY l) AS languages, count(*) AS n FROM u")
def unique_languages(spark, sf_dir):
    return I.languages(pairs(spark, sf_dir)).select(F.array_join("languages", ",").alias("languages"), "n")


@query("""WITH c AS (SELECT c_custkey AS pos, CAST(c_nationkey AS VARCHAR) AS s, CAST(c_custkey % 25 AS VARCHAR) AS t, c_custkey % 2 = 0 AS bi, 'old' AS checksum FROM customer),
g AS (SELECT s, t, score, checksum FROM (SELECT CAST(s_nationkey AS VARCHAR) AS s, CAST(s_suppkey % 25 AS VARCHAR) AS t, (s_suppkey * 7919 % 10001) / 10000 AS score, s_name AS checksum, row_number() OVER (PARTITION BY s_nationkey, s_suppkey % 25 ORDER BY s_suppkey DESC) AS n FROM supplier) WHERE n = 1)
SELECT c.pos, c.s AS source_language, c.t AS target_language, 'v2' AS version, CASE WHEN a.s IS NOT NULL THEN a.checksum WHEN bi AND b.s IS NOT NULL THEN b.checksum ELSE c.checksum END AS checksum,
 CASE WHEN a.s IS NOT NULL THEN CAST(printf('%.1f', a.score * 100) AS DOUBLE) WHEN bi AND b.s IS NOT NULL THEN CAST(printf('%.1f', b.score * 100) AS DOUBLE) END AS score
FROM c LEFT JOIN g a ON a.s = c.s AND a.t = c.t LEFT JOIN g b ON b.s = c.t AND b.t = c.s""")
def catalog_merge(spark, sf_dir):
    text = lambda x: F.expr(x).cast("string")
    catalog = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("pos"), text("c_nationkey").alias("source_language"), text("c_custkey % 25").alias("target_language"), F.expr("c_custkey % 2 = 0").alias("bidirectional"), F.lit("v1").alias("version"), F.lit("old").alias("checksum"), F.lit(None).cast("double").alias("score"))
    generated = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("pos"), text("s_nationkey").alias("source_language"), text("s_suppkey % 25").alias("target_language"), F.expr("(s_suppkey * 7919 % 10001) / 10000").alias("score"), F.col("s_name").alias("checksum"))
    return R.catalog_merge(catalog, generated, "v2").drop("bidirectional")


@query("SELECT p_partkey AS pos, 'part ' || (p_partkey // 2) AS id, CASE WHEN p_partkey = (SELECT min(p_partkey) FROM part WHERE p_partkey // 2 = 7) THEN 'new' ELSE p_brand END AS checksum FROM part")
def catalog_point_update(spark, sf_dir):
    catalog = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("pos"), F.expr("concat('part ', p_partkey div 2)").alias("id"), F.col("p_brand").alias("checksum"))
    return R.point_update(catalog, "part 7", {"checksum": F.lit("new")})


@query("""SELECT conv_id, count(*) > 1 AS bidirectional, '[' || string_agg('{"role":"' || role || '","size":' || f || ',"bidirectional":' || (CASE WHEN n > 1 THEN 'true' ELSE 'false' END) || '}', ',' ORDER BY turn) || ']' AS value
FROM (SELECT *, first_value(length(text)) OVER (PARTITION BY conv_id ORDER BY turn) AS f, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations) GROUP BY conv_id""")
def catalog_rebuild(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.length("text").alias("size"))
    return K.catalog_groups(rows, ["role", "size"], "conv_id", "turn")


@query("SELECT event_id, coalesce(TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE), 0.0) AS k FROM events")
def json_default(spark, sf_dir):
    from lodestone.sources.documents import json_number

    return table(spark, sf_dir, "events").select("event_id", json_number(F.col("props"), "$.k").alias("k"))


@query("SELECT event_id, value AS version_value, CASE WHEN user_id % 5 = 0 THEN 'v1.2.' || user_id WHEN user_id % 5 = 1 THEN 'dev v1.2.3' ELSE event_type END AS version FROM events")
def version_extract(spark, sf_dir):
    raw = F.when(F.col("user_id") % 5 == 0, F.concat(F.lit("v1.2."), F.col("user_id"), F.lit(" 2d067af 2024-02-16"))).when(F.col("user_id") % 5 == 1, F.lit("dev v1.2.3")).otherwise(F.col("event_type"))
    return table(spark, sf_dir, "events").select("event_id", F.col("value").alias("version_value"), X.version(raw).alias("version"))


@query("""SELECT page_id, CASE lower(l) WHEN 'zh' THEN 'zh' ELSE lower(split_part(l, '-', 1)) END AS plain, CASE WHEN page_id % 2 = 0 THEN 'zh_hant' ELSE 'zh' END AS chinese
FROM (SELECT page_id, regexp_extract(url, '^https?://[^/]+/([a-z]{2})/', 1) || '-US' AS l FROM pages)""")
def language_normalize(spark, sf_dir):
    code = F.concat(F.regexp_extract("url", "^https?://[^/]+/([a-z]{2})/", 1), F.lit("-US"))
    chinese = F.when(F.col("page_id") % 2 == 0, F.lit("zh_TW")).otherwise(F.lit("zh-Hans"))
    return table(spark, sf_dir, "pages").select("page_id", X.normalize_language(code).alias("plain"), X.normalize_language(chinese).alias("chinese"))


@query("""SELECT page_id, regexp_replace(regexp_extract(u, '([^/]*)/?$', 1), '(.)\\.[^.]+$', '\\1') AS stem, regexp_replace(u, '/[^/]*$', '') AS parent, u || '.tar.sha256' AS sidecar FROM (SELECT page_id, split_part(url, '#', 1) AS u FROM pages)""")
def name_stem(spark, sf_dir):
    u = F.substring_index("url", "#", 1)
    return table(spark, sf_dir, "pages").select("page_id", X.stem(u).alias("stem"), X.url_parent(u).alias("parent"), X.with_suffix(F.concat(u, F.lit(".tar.gz")), ".sha256").alias("sidecar"))


# Area B: integrity and packaging


@query("SELECT doc_id, sha256(coalesce(text, '')) AS digest, CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS size FROM documents")
def content_digest(spark, sf_dir):
    text = F.coalesce("text", F.lit(""))
    return table(spark, sf_dir, "documents").select("doc_id", B.digest(text).alias("digest"), B.n_bytes(text).alias("size"))


@query("SELECT sha256(text) AS digest, count(*) AS n, min(doc_id) AS first FROM documents WHERE text IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def bundle_digest_groups(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").filter("text is not null").select(B.digest(F.col("text")).alias("digest"), "doc_id")
    return rows.groupBy("digest").agg(F.count("*").alias("n"), F.min("doc_id").alias("first")).filter("n > 1")


@query("""WITH f AS (SELECT doc_id, lang FROM documents)
SELECT 'd' || doc_id AS name, CASE WHEN lang IS NULL OR lang = 'es' THEN 'missing' WHEN doc_id % 5 = 0 THEN 'size' WHEN doc_id % 3 = 0 THEN 'hash' ELSE 'ok' END AS status FROM f""")
def pack_verify(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", F.concat(F.lit("d"), "doc_id").alias("name"), F.length(F.coalesce("text", F.lit(""))).cast("long").alias("size"), B.digest(F.coalesce("text", F.lit(""))).alias("sha256"))
    files = docs.filter("lang <> 'es'").drop("doc_id", "lang")
    hashed = F.when(F.col("doc_id") % 3 == 0, F.lit("0")).otherwise(F.col("sha256"))
    sized = F.when(F.col("doc_id") % 5 == 0, F.col("size") + 1).otherwise(F.col("size"))
    return I.verify_pack(docs.select("name", sized.alias("sizeBytes"), hashed.alias("sha256")), files)


@query("""SELECT p_name AS name, p_partkey AS pos, 0 AS part FROM part WHERE p_name NOT IN (SELECT p_name FROM part WHERE p_size > 25)
UNION ALL SELECT p_name, max(p_partkey), 1 FROM part WHERE p_size > 25 GROUP BY p_name""")
def manifest_upsert(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    entry = lambda df: df.select(F.col("p_name").alias("name"), F.col("p_partkey").alias("pos"))
    return I.upsert(entry(part), entry(part.filter("p_size > 25")))


@query("""SELECT CAST(doc_id AS VARCHAR) AS dest, sha256(coalesce(text, '')) AS sha256, CASE WHEN doc_id % 4 = 1 THEN 'bad' WHEN doc_id % 4 = 2 THEN sha256(coalesce(text, '')) END AS pin, doc_id % 4 <> 1 AS ok FROM documents""")
def pin_compare(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("doc_id").cast("string").alias("dest"), B.digest(F.coalesce("text", F.lit(""))).alias("sha256"))
    pins = docs.select("dest", F.when(F.col("doc_id") % 4 == 1, F.lit("bad")).when(F.col("doc_id") % 4 == 2, F.col("sha256")).alias("sha256"))
    return I.compare_pins(docs, pins)


@query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)")
def missing_assets(spark, sf_dir):
    return I.absent(table(spark, sf_dir, "documents").select("doc_id", "source"), table(spark, sf_dir, "labels"), "doc_id")


@query("SELECT doc_id FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)")
def membership(spark, sf_dir):
    return I.members(table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels").filter("quality = 1"), "doc_id")


@query("""SELECT doc_id, CASE WHEN quality IS NULL THEN 'quality' ELSE '' END || CASE WHEN quality IS NULL AND toxic IS NULL THEN ', ' ELSE '' END || CASE WHEN toxic IS NULL THEN 'toxic' ELSE '' END AS missing
FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NULL OR toxic IS NULL""")
def required_fields(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return I.required(rows, "quality", "toxic").select("doc_id", "missing")


@query("""WITH v AS (SELECT * FROM (VALUES ('', 2), ('half', 1), ('quarter', 3)) AS t(variant, p))
SELECT p_partkey, 'detector' AS kind, variant, 'F_' || p_size || '_det' || CASE WHEN variant = '' THEN '' ELSE '_' || variant END || '_int8.mnn' AS name, CAST(p AS INTEGER) AS priority FROM part, v WHERE p_partkey % 3 = 0
UNION ALL SELECT p_partkey, CASE WHEN p_partkey % 3 = 1 THEN 'recognizer' ELSE 'aligner' END, '', CASE WHEN p_partkey % 3 = 1 THEN 'F_' || p_size || '_rec_int8.mnn' ELSE p_brand || '_int8.mnn' END, 1 FROM part WHERE p_partkey % 3 <> 0""")
def stage_cross(spark, sf_dir):
    kind = F.element_at(F.array(F.lit("detector"), F.lit("recognizer"), F.lit("aligner")), (F.col("p_partkey") % 3 + 1).cast("int"))
    specs = table(spark, sf_dir, "part").select("p_partkey", kind.alias("kind"), F.col("p_size").cast("string").alias("tier"), F.col("p_brand").alias("stem"))
    v = E.with_variants(specs, ["half", "quarter"])
    return v.select("p_partkey", "kind", "variant", E.artifact_name(F.col("kind"), F.col("tier"), F.col("stem"), F.col("variant"), "F").alias("name"), E.priority(F.col("kind"), F.col("variant")).alias("priority"))


@query("SELECT r_regionkey, r_name || chr(0) AS token, lower(hex(encode(r_name))) || '00' || lpad(lower(hex(r_regionkey)), 2, '0') || '000000' AS entry FROM region")
def vocabulary_entry(spark, sf_dir):
    return table(spark, sf_dir, "region").select("r_regionkey", F.concat("r_name", F.decode(F.unhex(F.lit("00")), "UTF-8")).alias("token"), F.lower(F.hex(B.vocabulary_entry(F.col("r_name"), F.col("r_regionkey")))).alias("entry"))


# Area C: datasets

TOKENS = "SELECT doc_id, unnest(string_split(text, ' ')) AS w FROM documents"


def tokens(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.explode(F.split("text", " ")).alias("w"))


@query(f"WITH t AS ({TOKENS}) SELECT w, count(*) AS n FROM t WHERE length(w) BETWEEN 2 AND 12 AND (regexp_full_match(w, '\\p{{L}}+') OR w = lower(w)) AND NOT regexp_matches(w, '\\s') GROUP BY w")
def token_filter(spark, sf_dir):
    return tokens(spark, sf_dir).filter(D.keep_token(F.col("w")) & ~F.col("w").rlike(r"\s")).groupBy("w").agg(F.count("*").alias("n"))


@query(f"WITH t AS ({TOKENS}) SELECT w, count(*) AS n FROM t WHERE regexp_full_match(w, '[a-zà-ÿ]{{2,12}}') GROUP BY w")
def script_filter(spark, sf_dir):
    return tokens(spark, sf_dir).filter(D.keep_script(F.col("w"), [(0x61, 0x7A), (0xE0, 0xFF)])).groupBy("w").agg(F.count("*").alias("n"))


@query(f"WITH t AS ({TOKENS}) SELECT w, n FROM (SELECT w, count(*) AS n FROM t GROUP BY w) ORDER BY n DESC, w LIMIT 50")
def top_tokens(spark, sf_dir):
    return tokens(spark, sf_dir).groupBy("w").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "w").limit(50)


UNIFORM = "CAST('0x' || substr(sha256(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296.0"


@query(f"SELECT doc_id, {UNIFORM} AS r FROM documents")
def hash_uniform(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", N.uniform(F.col("doc_id")).alias("r"))


@query(f"""SELECT doc_id, CASE WHEN r < 50 / 100.0 THEN 'latin' WHEN r < 70 / 100.0 THEN 'cjk' WHEN r < 80 / 100.0 THEN 'arabic' WHEN r < 88 / 100.0 THEN 'devanagari' WHEN r < 94 / 100.0 THEN 'tamil' ELSE 'thai' END AS script FROM (SELECT doc_id, {UNIFORM} AS r FROM documents)""")
def weighted_choice(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", N.uniform(F.col("doc_id")).alias("r"))
    return D.inverse_cdf(rows, L.script_weights(spark)).select("doc_id", "script")


@query("""SELECT doc_id, CAST(i // 100 AS INTEGER) AS shard_no, CAST(i % 100 AS INTEGER) AS row, printf('train-%05d-of-%05d.parquet', CAST(i // 100 AS INTEGER), CAST(greatest(1, (n + 99) // 100) AS INTEGER)) AS shard, i AS index
FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i, count(*) OVER () AS n FROM documents)""")
def shard_assign(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return D.shards(D.numbered(docs, "doc_id"), docs.count(), 100)


@query("""WITH t AS (SELECT doc_id, lang, row_number() OVER (ORDER BY doc_id) - 1 AS i, count(*) OVER () AS n FROM documents WHERE {U} >= 0.2),
v AS (SELECT doc_id, lang, row_number() OVER (ORDER BY doc_id) - 1 AS i, count(*) OVER () AS n FROM documents WHERE {U} < 0.2),
s AS (SELECT doc_id, lang, i AS index, printf('train-%05d-of-%05d.parquet', CAST(i // 250 AS INTEGER), CAST(greatest(1, (n + 249) // 250) AS INTEGER)) AS shard, CAST(i % 250 AS INTEGER) AS row FROM t
UNION ALL SELECT doc_id, lang, i + (SELECT count(*) FROM t), 'validation-00000-of-00001.parquet', CAST(i AS INTEGER) FROM v)
SELECT index, '{"index":' || index || ',"shard":"' || shard || '","row":' || row || coalesce(',"script":"' || lang || '"', '') || '}' AS value FROM s""".replace("{U}", UNIFORM))
def shard_lineage(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    r = N.uniform(F.col("doc_id"))
    train, val = docs.filter(r >= 0.2), docs.filter(r < 0.2)
    n, m = train.count(), val.count()
    rows = D.shards(D.numbered(train, "doc_id"), n, 250).unionByName(D.shards(D.numbered(val, "doc_id"), m, max(m, 250), "validation", n))
    return rows.select("index", K.document("index", "shard", "row", F.col("lang").alias("script")).alias("value"))


@query("""WITH s AS (SELECT r_regionkey AS index FROM region), h AS (SELECT CAST(index % 7 AS INTEGER) AS worker, index FROM s)
SELECT worker, index FROM h UNION ALL SELECT CAST(w AS INTEGER), index FROM s, range(7) AS t(w) WHERE w NOT IN (SELECT worker FROM h)""")
def worker_partition(spark, sf_dir):
    return D.workers(table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("index")), 7).select("worker", "index")


@query("""SELECT doc_id, width, CAST((n - 1) // 8 AS INTEGER) AS batch FROM (SELECT doc_id, n_chars // 200 * 16 + 96 AS width, row_number() OVER (PARTITION BY n_chars // 200 ORDER BY doc_id) AS n, count(*) OVER (PARTITION BY n_chars // 200) AS c FROM documents) WHERE ((n - 1) // 8 + 1) * 8 <= c""")
def width_batches(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.expr("n_chars div 200 * 16 + 96").alias("width"))
    return D.batches(docs, "width", "doc_id", 8)


@query("SELECT l_orderkey, l_linenumber, CAST(r AS INTEGER) AS replay FROM lineitem, range(1, 4) AS t(r)")
def replayed_rows(spark, sf_dir):
    return D.replayed(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber"), 3)


@query("SELECT vec_id, CAST(sum(v) AS DOUBLE) AS total, count(*) AS n FROM (SELECT vec_id, CAST(e AS DOUBLE) AS v, i FROM (SELECT vec_id, unnest(embedding) AS e, unnest(range(len(embedding))) AS i FROM embeddings) WHERE i % 6 = 0) GROUP BY vec_id")
def stride_sample(spark, sf_dir):
    s = A.stride_sample(F.col("embedding"), 10)
    return table(spark, sf_dir, "embeddings").select("vec_id", A.total(s).alias("total"), F.size(s).cast("long").alias("n"))


@query("SELECT vec_id, array_to_string(list_transform(list_sort(embedding)[1:3], lambda x: printf('%.4f', CAST(x AS DOUBLE))), ',') AS smallest FROM embeddings")
def k_smallest(spark, sf_dir):
    s = F.transform(A.smallest(F.col("embedding"), 3), lambda x: F.format_string("%.4f", x.cast("double")))
    return table(spark, sf_dir, "embeddings").select("vec_id", F.array_join(s, ",").alias("smallest"))


@query("SELECT doc_id, (16 - n_chars % 16) % 16 AS padding FROM documents")
def pad_width(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", N.padding(F.col("n_chars")).alias("padding"))


@query("""SELECT doc_id, CASE WHEN r < 0.15 THEN 'Ab cd。' WHEN r < 0.22 THEN '「Ab cd」' WHEN r < 0.30 THEN 'Ab cd、' ELSE 'Ab cd' END AS cjk,
 CASE WHEN r < 0.30 THEN 'Ab cd.' WHEN r < 0.45 THEN 'Ab cd,' WHEN r < 0.55 THEN '"Ab cd"' WHEN r < 0.60 THEN 'Ab-cd' ELSE 'Ab cd' END AS latin, CASE WHEN r < 0.55 THEN 'Ab cd' WHEN r < 0.80 THEN 'Ab Cd' ELSE 'AB CD' END AS cased
FROM (SELECT doc_id, """ + UNIFORM + " AS r FROM documents)")
def punctuation(spark, sf_dir):
    r, text = N.uniform(F.col("doc_id")), F.lit("Ab cd")
    return table(spark, sf_dir, "documents").select("doc_id", X.punctuated(text, r, F.lit(True)).alias("cjk"), X.punctuated(text, r, F.lit(False)).alias("latin"), X.cased(text, r).alias("cased"))


@query("SELECT DISTINCT n_regionkey AS k FROM nation UNION SELECT s_suppkey FROM supplier")
def set_union(spark, sf_dir):
    a = table(spark, sf_dir, "nation").select(F.col("n_regionkey").cast("long").alias("k"))
    return a.union(table(spark, sf_dir, "supplier").select("s_suppkey")).distinct()


# Area D: evaluation


@query("SELECT vec_id, round(avg(1 / (1 + exp(-least(greatest(CAST(e AS DOUBLE), -30), 30)))), 9) AS s, round(avg(1 / (1 + exp(-least(greatest((CAST(e AS DOUBLE) - 0.075) / 0.008, -30), 30)))), 9) AS w FROM (SELECT vec_id, unnest(embedding) AS e FROM embeddings) GROUP BY vec_id")
def sigmoid_weight(spark, sf_dir):
    e = F.col("embedding")
    mean = lambda f: F.round(A.total(F.transform(e, lambda x: f(x.cast("double")))) / F.size(e), 9)
    return table(spark, sf_dir, "embeddings").select("vec_id", mean(N.sigmoid).alias("s"), mean(N.weight_target).alias("w"))


STRIPS = "SELECT a.vec_id AS strip_id, a.embedding AS p, b.embedding AS t FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1"


def strips(spark, sf_dir) -> DataFrame:
    """Predictions and labels: each vector with the next one."""
    e = table(spark, sf_dir, "embeddings")
    a = e.select(F.col("vec_id").alias("strip_id"), F.col("embedding").alias("p"))
    return a.join(e.select((F.col("vec_id") - 1).alias("strip_id"), F.col("embedding").alias("t")), "strip_id")


PIXELS = f"SELECT strip_id, CAST(unnest(p) AS DOUBLE) AS p, CAST(unnest(t) AS DOUBLE) AS t FROM ({STRIPS})"


@query(f"SELECT strip_id, round(CAST(count(*) FILTER (p > 0 AND t > 0) AS DOUBLE) / greatest(count(*) FILTER (p > 0 OR t > 0), 1), 9) AS iou FROM ({PIXELS}) GROUP BY strip_id")
def mask_iou(spark, sf_dir):
    return strips(spark, sf_dir).select("strip_id", F.round(M.iou(A.above(F.col("p"), 0.0), A.above(F.col("t"), 0.0)), 9).alias("iou"))


@query(f"SELECT strip_id, CASE WHEN count(*) FILTER (t > 0) >= 30 THEN round(avg(abs(p - t)) FILTER (t > 0), 9) END AS mae FROM ({PIXELS}) GROUP BY strip_id")
def masked_mae(spark, sf_dir):
    mae = M.masked_mae(F.col("p"), F.col("t"), A.above(F.col("t"), 0.0))
    return strips(spark, sf_dir).select("strip_id", F.round(N.skip_nan(mae), 9).alias("mae"))


@query("""WITH s AS (SELECT label % 2 AS k, label / 10.0 AS t, list_max(embedding) AS p FROM embeddings)
SELECT a.k AS k, round(sum(CASE WHEN a.p > b.p THEN 1.0 WHEN a.p = b.p THEN 0.5 ELSE 0.0 END) / count(*), 9) AS auc FROM s a JOIN s b ON a.k = b.k AND a.t - b.t > 0.25 GROUP BY a.k""")
def pairwise_auc(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select((F.col("label") % 2).alias("k"), (F.col("label") / F.lit(10.0)).alias("t"), F.array_max("embedding").alias("p"))
    return M.pairwise_auc(rows, ["k"], "t", "p").select("k", F.round("auc", 9).alias("auc"))


@query("""SELECT label, round(avg(v), 9) AS mean, round(quantile_cont(v, 0.05), 9) AS p5, round(quantile_cont(v, 0.95), 9) AS p95, round(max(v), 9) AS max FROM (SELECT label, CAST(list_max(embedding) AS DOUBLE) AS v FROM embeddings WHERE vec_id % 3 <> 0) GROUP BY label""")
def nan_percentile(spark, sf_dir):
    v = F.when(F.col("vec_id") % 3 == 0, F.lit(float("nan"))).otherwise(F.array_max("embedding").cast("double"))
    s = M.summary(table(spark, sf_dir, "embeddings").select("label", v.alias("v")), ["label"], "v")
    return s.select("label", *[F.round(c, 9).alias(c) for c in ("mean", "p5", "p95", "max")])


@query("""SELECT vec_id, round(greatest(abs(list_aggregate(CAST(embedding[1:16] AS DOUBLE[]), 'median') - list_aggregate(CAST(embedding[33:48] AS DOUBLE[]), 'median')), abs(list_aggregate(CAST(embedding[17:32] AS DOUBLE[]), 'median') - list_aggregate(CAST(embedding[49:64] AS DOUBLE[]), 'median'))), 9) AS contrast FROM embeddings""")
def median_contrast(spark, sf_dir):
    cut = lambda a: F.slice("embedding", a, 16)
    c = M.contrast(F.array(cut(1), cut(17)), F.array(cut(33), cut(49)))
    return table(spark, sf_dir, "embeddings").select("vec_id", F.round(c, 9).alias("contrast"))


@query(f"""WITH s AS (SELECT strip_id, CAST(count(*) FILTER (p > 0 AND t > 0) AS DOUBLE) / greatest(count(*) FILTER (p > 0 OR t > 0), 1) AS iou, avg(abs(p - t)) AS d1, avg(abs(p + t)) AS d2 FROM ({PIXELS}) GROUP BY strip_id)
SELECT round(avg(iou), 9) AS iou, round(avg((d1 + d2) / 2), 9) AS delta FROM s""")
def parity(spark, sf_dir):
    s = strips(spark, sf_dir)
    mean = lambda f: A.total(F.zip_with("p", "t", lambda x, y: F.abs(f(x.cast("double"), y.cast("double"))))) / F.size("p")
    rows = s.select(M.iou(A.above(F.col("p"), 0.0), A.above(F.col("t"), 0.0)).alias("iou"), mean(lambda x, y: x - y).alias("d1"), mean(lambda x, y: x + y).alias("d2"))
    return M.parity(rows, "iou", ["d1", "d2"]).select(F.round("iou", 9).alias("iou"), F.round("delta", 9).alias("delta"))


@query("""WITH c AS (SELECT vec_id, i, CAST(embedding[2 * i + 1] AS DOUBLE) AS x, CAST(embedding[2 * i + 2] AS DOUBLE) AS y, CAST(embedding[2 * i + 33] AS DOUBLE) AS u, CAST(embedding[2 * i + 34] AS DOUBLE) AS v FROM embeddings, range(16) AS t(i)),
d AS (SELECT a.vec_id, a.i, min(sqrt((a.x - b.u) * (a.x - b.u) + (a.y - b.v) * (a.y - b.v))) AS d FROM c a JOIN c b USING (vec_id) GROUP BY 1, 2) SELECT vec_id, round(max(d), 9) AS error FROM d GROUP BY vec_id""")
def nearest_point(spark, sf_dir):
    e = F.transform("embedding", lambda v: v.cast("double"))
    corners = lambda start: F.array(*[F.struct(e[start + 2 * i].alias("x"), e[start + 2 * i + 1].alias("y")) for i in range(16)])
    return table(spark, sf_dir, "embeddings").select("vec_id", F.round(M.nearest_corner(corners(0), corners(32)), 9).alias("error"))


@query("""SELECT round(avg(m), 9) AS value FROM (SELECT event_id // 25 AS b, sum(CASE WHEN event_type = 'click' THEN value ELSE 0 END) / (count(*) FILTER (event_type = 'click') + 1e-6) AS m FROM events GROUP BY 1)""")
def batch_means(spark, sf_dir):
    rows = table(spark, sf_dir, "events").withColumn("b", F.expr("event_id div 25"))
    return M.mean_of_batch_means(rows, "b", F.col("value"), F.col("event_type") == "click").select(F.round("value", 9).alias("value"))


@query("SELECT event_id // 25 AS window, round(avg(value), 9) AS loss FROM events GROUP BY 1")
def running_loss(spark, sf_dir):
    return M.running_loss(table(spark, sf_dir, "events"), "event_id", "value").select("window", F.round("loss", 9).alias("loss"))


@query("SELECT l_returnflag AS k, round(1 - (2 * sum(l_discount * l_tax) + 1) / (sum(l_discount) + sum(l_tax) + 1), 9) AS dice, round(-avg(l_tax * ln(least(greatest(l_discount, 0.0000001), 0.9999999)) + (1 - l_tax) * ln(1 - least(greatest(l_discount, 0.0000001), 0.9999999))), 9) AS bce FROM lineitem GROUP BY 1")
def losses(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_returnflag").alias("k")).agg(F.round(M.dice("l_discount", "l_tax"), 9).alias("dice"), F.round(M.bce("l_discount", "l_tax"), 9).alias("bce"))


@query("SELECT event_type AS model, '{' || string_agg('\"' || metric || '\":' || CAST(v AS VARCHAR), ',' ORDER BY metric) || '}' AS value FROM (SELECT event_type, 'm' || (user_id % 4) AS metric, count(*) AS v FROM events GROUP BY 1, 2) GROUP BY event_type")
def metric_report(spark, sf_dir):
    m = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("model"), F.concat(F.lit("m"), F.col("user_id") % 4).alias("metric")).agg(F.count("*").alias("value"))
    return K.report(m)


# Smaller operators


@query("SELECT p_partkey, p_brand FROM part WHERE NOT (starts_with(p_brand, 'Brand#1') OR starts_with(p_brand, 'Brand#2'))")
def prefix_exclusion(spark, sf_dir):
    return table(spark, sf_dir, "part").filter(~E.excluded(F.col("p_brand"), ["Brand#1", "Brand#2"])).select("p_partkey", "p_brand")


@query("SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 'en' ELSE 'de,en,fr' END AS languages FROM part")
def language_set(spark, sf_dir):
    variant = F.when(F.col("p_size") % 2 == 0, F.concat("p_brand", F.lit(".en"))).otherwise(F.col("p_brand"))
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(I.language_set(variant, ["de", "en", "fr"]), ",").alias("languages"))


@query("SELECT p_partkey, CASE WHEN p_size > 25 THEN 'hub/' || p_brand ELSE 'http://' || p_name END AS source FROM part")
def source_choice(spark, sf_dir):
    hub = F.when(F.col("p_size") > 25, F.concat(F.lit("hub/"), "p_brand"))
    return table(spark, sf_dir, "part").select("p_partkey", I.source_of(hub, F.concat(F.lit("http://"), "p_name")).alias("source"))


@query("SELECT o_orderkey, o_orderstatus <> 'O' AS done FROM orders")
def boolean_text(spark, sf_dir):
    text = F.when(F.col("o_orderstatus") == "F", "Yes").when(F.col("o_orderstatus") == "P", "1").otherwise("no")
    return table(spark, sf_dir, "orders").select("o_orderkey", X.to_boolean(text).alias("done"))


@query("""SELECT event_id, user_id AS first, '{"voice":{"model":{"file":"base/' || event_type || '.bin","note":"' || event_type || '","deep":{"a":"base/x/' || user_id || '.json","b":"/abs/x.bin"}}},"config":"base/c.json"}' AS paths FROM events""")
def map_functions(spark, sf_dir):
    first = A.first_of_each(F.create_map(F.lit("a"), F.array("user_id", "event_id")))["a"]
    deep = F.create_map(F.lit("a"), F.concat(F.lit("x/"), "user_id", F.lit(".json")), F.lit("b"), F.lit("/abs/x.bin"))
    model = F.struct(F.concat("event_type", F.lit(".bin")).alias("file"), F.col("event_type").alias("note"), deep.alias("deep"))
    files = table(spark, sf_dir, "events").select("event_id", first.alias("first"), F.struct(F.create_map(F.lit("model"), model).alias("voice"), F.lit("c.json").alias("config")).alias("f"))
    return files.select("event_id", "first", F.to_json(X.under(F.lit("base"), F.col("f"), files.schema["f"].dataType)).alias("paths"))


@query("SELECT c_custkey, coalesce(string_agg(DISTINCT o_orderstatus, ', ' ORDER BY o_orderstatus), 'none') AS available FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey")
def names_joined(spark, sf_dir):
    met = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "orders"), F.col("o_custkey") == F.col("c_custkey"), "left")
    return met.groupBy("c_custkey").agg(X.names_or_none(F.array_sort(F.collect_set("o_orderstatus"))).alias("available"))


@query("SELECT 'd' || doc_id || '.tar.sha256' AS path, sha256(coalesce(text, '')) || '  d' || doc_id || '.tar.gz' AS value FROM documents")
def checksum_sidecar(spark, sf_dir):
    files = table(spark, sf_dir, "documents").select(F.concat(F.lit("d"), "doc_id", F.lit(".tar.gz")).alias("path"), F.coalesce("text", F.lit("")).alias("content"))
    return K.sidecars(files)


@query("SELECT o_orderkey, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 20")
def first_rows(spark, sf_dir):
    return D.first_n(table(spark, sf_dir, "orders"), "o_orderkey", 20).select("o_orderkey", "o_orderstatus")


@query("SELECT a.vec_id AS vec_id, a.label AS label, b.label AS other_label FROM embeddings a JOIN embeddings b USING (vec_id)")
def position_zip(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select("vec_id", "label")
    return M.zipped(e, e, "vec_id")


@query("""SELECT CASE n_nationkey % 5 WHEN 0 THEN 'arabic' WHEN 1 THEN 'devanagari' WHEN 2 THEN 'tamil' ELSE 'cjk' END AS script, n_name AS word FROM nation
UNION ALL SELECT 'thai', chr(CAST(p AS INTEGER)) FROM range(3584, 3712) AS t(p)""")
def lookup_chain(spark, sf_dir):
    code = F.element_at(F.array(*[F.lit(x) for x in ("ar", "hi", "ta", "zh_cn", "ja")]), F.col("n_nationkey") % 5 + 1)
    return G.script_fallback(table(spark, sf_dir, "nation").select(code.alias("code"), F.col("n_name").alias("word")), L.script_words(spark))


@query("SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users FROM events GROUP BY event_type")
def group_counts(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("users"))


@query("SELECT o_orderstatus, round(avg(o_totalprice), 4) AS mean, round(quantile_cont(o_totalprice, 0.95), 4) AS p95, round(max(o_totalprice), 4) AS max FROM orders GROUP BY o_orderstatus")
def tail_summary(spark, sf_dir):
    s = M.summary(table(spark, sf_dir, "orders"), ["o_orderstatus"], "o_totalprice")
    return s.select("o_orderstatus", *[F.round(c, 4).alias(c) for c in ("mean", "p95", "max")])


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity < 20 THEN 0.0 ELSE least(2 * l_discount / greatest(l_tax, 1), 0.45) END AS ratio FROM lineitem")
def stroke_ratio(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", M.stroke_ratio(F.col("l_discount"), F.col("l_tax"), F.col("l_quantity")).alias("ratio"))


@query("SELECT l_returnflag, round(avg(l_discount), 3) AS r, round(avg(l_tax), 3) AS g FROM lineitem GROUP BY l_returnflag")
def region_color(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").withColumnsRenamed({"l_discount": "r", "l_tax": "g"})
    return M.region_color(rows, ["l_returnflag"], ["r", "g"], 3)


@query("SELECT p_brand, CAST(sum(p_size * 3) AS BIGINT) AS parameters FROM part GROUP BY p_brand")
def parameter_total(spark, sf_dir):
    shape = F.array(F.col("p_size"), F.lit(3))
    return table(spark, sf_dir, "part").groupBy("p_brand").agg(M.parameter_count(shape).alias("parameters"))


@query("SELECT event_type, round(count(*) / nullif(epoch(max(ts)) - epoch(min(ts)), 0), 9) AS rate FROM events GROUP BY event_type")
def throughput(spark, sf_dir):
    at = F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1e6)
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.round(M.throughput(F.count("*"), F.max(at) - F.min(at)), 9).alias("rate"))


@query("SELECT n_name AS name FROM nation UNION ALL SELECT r_name FROM region")
def list_concat(spark, sf_dir):
    return table(spark, sf_dir, "nation").select(F.col("n_name").alias("name")).unionByName(table(spark, sf_dir, "region").select(F.col("r_name").alias("name")))


@query("SELECT event_id, event_id % 25 = 0 AS reports, event_id % 500 = 0 AS validates FROM events")
def periodic_steps(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", D.periodic(F.col("event_id"), 25).alias("reports"), D.periodic(F.col("event_id"), 500).alias("validates"))


@query("""WITH s AS (SELECT p_partkey, p_brand, CASE p_partkey % 3 WHEN 0 THEN 'detector' WHEN 1 THEN 'recognizer' ELSE 'aligner' END AS kind, CAST(p_size AS VARCHAR) AS tier, CASE WHEN p_partkey % 2 = 0 THEN 'cj' ELSE '' END AS script FROM part),
v AS (SELECT * FROM (VALUES ('', 2), ('quarter', 3)) AS t(variant, p))
SELECT 'F_' || tier || '_det' || CASE WHEN variant = '' THEN '' ELSE '_quarter' END || '_int8.mnn' AS name, kind AS role, nullif(script, '') AS script, CAST(p AS INTEGER) AS priority, CASE WHEN variant = 'quarter' THEN 'stills only' END AS note FROM s, v WHERE kind = 'detector'
UNION ALL SELECT CASE kind WHEN 'recognizer' THEN 'F_' || tier || '_rec_int8.mnn' ELSE p_brand || '_int8.mnn' END, kind, CASE WHEN kind = 'recognizer' THEN script ELSE nullif(script, '') END, 1, NULL FROM s WHERE kind <> 'detector'
UNION ALL SELECT 'F_' || tier || '_keys.txt', 'keys', script, 1, NULL FROM s WHERE kind = 'recognizer'""")
def manifest_rows(spark, sf_dir):
    kind = F.element_at(F.array(F.lit("detector"), F.lit("recognizer"), F.lit("aligner")), (F.col("p_partkey") % 3 + 1).cast("int"))
    specs = table(spark, sf_dir, "part").select(kind.alias("kind"), F.col("p_size").cast("string").alias("tier"), F.col("p_brand").alias("stem"), F.when(F.col("p_partkey") % 2 == 0, "cj").otherwise("").alias("script"), F.lit(None).cast("string").alias("note"))
    return E.manifest_rows(E.with_variants(specs, ["quarter"]), "F", "stills only")


@query("SELECT p_partkey, array_to_string(list_transform(string_split(p_type, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') AS title, trim(p_type) AS stripped FROM part")
def title_case(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", X.title(F.col("p_type")).alias("title"), X.strip(F.concat(F.lit(" \n"), "p_type", F.lit("\t"))).alias("stripped"))


@query("SELECT doc_id, regexp_matches(coalesce(text, ''), '\\p{M}') AS marked FROM documents")
def unicode_marks(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", X.has_mark(F.coalesce("text", F.lit(""))).alias("marked"))


@query("SELECT l_orderkey, l_linenumber, least(greatest(l_discount, 0.02), 0.08) AS clipped, round(sqrt(l_discount * l_discount + l_tax * l_tax), 9) AS norm, round(0.13 + 0.006 * greatest(0, 30 - l_quantity), 9) AS threshold FROM lineitem")
def scalar_arithmetic(spark, sf_dir):
    d, t = F.col("l_discount"), F.col("l_tax")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", N.clip(d, 0.02, 0.08).alias("clipped"), F.round(N.l2(d, t), 9).alias("norm"), F.round(N.contrast_threshold(F.col("l_quantity")), 9).alias("threshold"))


@query("SELECT doc_id, coalesce(nullif(CASE WHEN doc_id % 3 = 0 THEN '' WHEN doc_id % 3 = 1 THEN lang END, ''), source) AS value FROM documents")
def default_value(spark, sf_dir):
    value = F.when(F.col("doc_id") % 3 == 0, "").when(F.col("doc_id") % 3 == 1, F.col("lang"))
    return table(spark, sf_dir, "documents").select("doc_id", X.default(value, F.col("source"), empty_too=True).alias("value"))


@query("SELECT s_suppkey, round(s_acctbal / sum(s_acctbal) OVER (), 9) AS share FROM supplier")
def weight_share(spark, sf_dir):
    rows = table(spark, sf_dir, "supplier")
    total = rows.agg(F.sum("s_acctbal").alias("t"))
    return rows.select("s_suppkey", F.round(F.col("s_acctbal") / total.scalar(), 9).alias("share"))


from lodestone.plans import landed  # noqa: E402, F401  (registers its queries)
