"""The queries of this subpackage: thin forms of its operators over the standard tables, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontam, jaccard, langid, packing, quality, secret_scan, token_counts, vector_dedup, warc
from .common import held_out, scratch, table

BPE, PIECES = "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"


def op1_packed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(BPE), public_tokenizers.PATTERN)


def op2_bpe_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path(BPE), public_tokenizers.PATTERN, decoded=True))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.fit(docs)).select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def op6_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.links(table(spark, sf_dir, "embeddings"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.annotate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), unnamed=True)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, prefix = scratch(spark, "warc"), "urn:x-page:"
    warc.archive(table(spark, sf_dir, "pages"), path, "page_id", "url", "html", prefix, unnamed=True)
    found = warc.read(spark, path).filter(F.col("record_type").isin("response", "revisit"))
    number = lambda x: F.nullif(F.substring_index(x, ":", -1), F.lit("null")).cast("long")
    size = F.when(F.col("record_type") == "response", F.octet_length("payload")).otherwise(F.col("payload_bytes"))
    return found.select(number("record_id").alias("page_id"), size.cast("long").alias("payload_bytes"), "payload_digest", "record_type", number("refers_to").alias("refers_to"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.links(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links", "copy_of", "kept")


def op10_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.report(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans", "n_live", "n_example")


QUERIES = {x.__name__: x for x in (op1_packed_rows, op2_bpe_tree, op3_token_counts, op4_language, op5_quality, op6_nn_descent, op7_decontamination, op8_warc, op9_jaccard_join, op10_secret_ownership)}

ORACLE = {
    "op7_decontamination": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[k:k + 9], ' ') AS win FROM b, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS t(k) WHERE len(w) > 0),
n AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, n.n AS n, k, array_to_string(w[k:k + n.n - 1], ' ') AS win FROM d, n, unnest(range(1, greatest(0, len(w) - n.n + 1) + 1)) AS t(k)),
hit AS (SELECT doc_id, k, dw.n AS n, item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.win = bw.win),
p AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM hit, unnest(range(k, k + n)) AS t(pos) GROUP BY doc_id),
i AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN p USING (doc_id) LEFT JOIN i USING (doc_id)
""",
    "op8_warc": r"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + ((CAST('0x' || substr(h, (k // 4) * 5 + 1, 5) AS BIGINT) >> (15 - 5 * (k % 4))) & 31) AS BIGINT), 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM f
""",
    "op10_secret_ownership": r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
m AS (
  SELECT doc_id, source, 'assign' AS kind, 0 AS rank, regexp_extract_all(t, P0, 0) AS m, regexp_extract_all(t, P0, 2) AS v, string_split_regex(t, P0) AS g FROM d
  UNION ALL SELECT doc_id, source, 'access', 1, regexp_extract_all(t, P1), regexp_extract_all(t, P1), string_split_regex(t, P1) FROM d
  UNION ALL SELECT doc_id, source, 'hex', 2, regexp_extract_all(t, P2), regexp_extract_all(t, P2), string_split_regex(t, P2) FROM d
  UNION ALL SELECT doc_id, source, 'owned', 3, regexp_extract_all(t, P3), regexp_extract_all(t, P3), string_split_regex(t, P3) FROM d),
s AS (SELECT doc_id, source, kind, rank, v[i] AS value, list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS a, length(m[i]) AS n FROM m, unnest(range(1, len(m) + 1)) AS t(i)),
f AS (SELECT doc_id, source, kind, rank, value, CAST(a AS BIGINT) AS a, CAST(a + n AS BIGINT) AS b FROM s WHERE (rank > 0 OR length(value) >= 6) AND (rank < 3 OR regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]'))),
c AS (SELECT * FROM f WHERE rank < 3 UNION ALL SELECT * FROM f WHERE rank = 3 AND NOT EXISTS (SELECT 1 FROM f AS o WHERE o.rank < 3 AND o.doc_id = f.doc_id AND o.a < f.b AND f.a < o.b)),
h AS (SELECT value, count(DISTINCT source) AS n_owners, count(DISTINCT {'source': source, 'doc': doc_id}) FILTER (doc_id IS NOT NULL) AS n_repos, bool_or(rank < 3) AS credential FROM c GROUP BY value),
j AS (SELECT c.*, n_owners < 3 AND n_repos < 20 AS live FROM c JOIN h USING (value) WHERE rank < 3 OR n_owners < 3 AND n_repos < 20 AND (credential OR regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Z]') AND regexp_matches(value, '[a-z]'))),
r AS (SELECT doc_id, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access, count(*) FILTER (rank = 2) AS n_hex, string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, rank, b) FILTER (rank < 3) AS base, string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, rank, b) AS spans, count(*) FILTER (live) AS n_live, count(*) FILTER (NOT live) AS n_example FROM j GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example FROM d LEFT JOIN r USING (doc_id)
""",
}
P = (r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", "AKIA[A-Z0-9]{16,}", "[0-9a-f]{24,}", "[A-Za-z0-9+/_=-]{20,}")
for _k, _p in enumerate(P):
    ORACLE["op10_secret_ownership"] = ORACLE["op10_secret_ownership"].replace(f"P{_k}", f"'{_p}'")
