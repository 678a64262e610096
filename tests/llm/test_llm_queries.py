"""The registered queries: against SQL where there is some, against brute force or the libraries elsewhere."""

import base64
import hashlib
import math
import zlib

import duckdb
import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
import tiktoken
from test_jaccard import grams

from lodestone.llm import queries

NAMES = "documents embeddings pages benchmark labels".split()


def plain(v):
    return "nan" if isinstance(v, float) and math.isnan(v) else str(v)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_same_rows_as_sql(spark, small, name):
    c = duckdb.connect()
    for t in NAMES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    df, sql = queries.QUERIES[name](spark, small), c.sql(queries.ORACLE[name])
    order = sorted(df.columns)
    assert order == sorted(sql.columns)
    at = [sql.columns.index(x) for x in order]
    assert sorted(tuple(plain(r[x]) for x in order) for r in df.collect()) == sorted(tuple(plain(r[k]) for k in at) for r in sql.fetchall())


def test_token_values(spark, small):
    """The libraries themselves, over whole texts."""
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path(queries.BPE), "rb"))}
    bpe = tiktoken.Encoding("test", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    pieces = sentencepiece.SentencePieceProcessor(model_file=P.path(queries.PIECES))
    sha = lambda x: hashlib.sha256(x).hexdigest()
    for r in queries.op2_bpe_tree(spark, small).collect():
        ids = bpe.encode_ordinary(docs[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(" ".join(map(str, ids)).encode()), sha(docs[r.doc_id].encode()))
    for r in queries.op3_token_counts(spark, small).collect():
        n = len(pieces.encode(docs[r.doc_id]))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(docs[r.doc_id].encode()), n, n > 4096)


def groups(links, ids):
    """The smallest id that is reachable from each, and the number of direct links."""
    top, n = {k: k for k in ids}, dict.fromkeys(ids, 0)

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in links:
        n[a] += 1
        n[b] += 1
        p, q = find(a), find(b)
        top[max(p, q)] = min(p, q)
    return {k: (n[k], find(k)) for k in ids}


def test_link_values(spark, small):
    """Every pair looked at: cosines within labels, and Jaccard of word 5-grams."""
    rows = [r for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    by, pairs = {}, []
    for r in rows:
        v = None if r.embedding is None or None in r.embedding else np.array(r.embedding, float)
        if v is not None and r.label is not None and np.isfinite(v).all() and v.any():
            by.setdefault(r.label, []).append((r.vec_id, v / np.linalg.norm(v)))
    for members in by.values():
        x = np.array([v for _, v in members])
        pairs += [(members[a][0], members[b][0]) for a, b in zip(*np.nonzero(np.triu(x @ x.T >= 0.93, 1)))]
    want = groups(pairs, [r.vec_id for r in rows])
    assert {r.vec_id: (r.n_links, r.component_id) for r in queries.op6_nn_descent(spark, small).collect()} == want
    docs = {r.doc_id: grams(r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    pairs = [(a, b) for a in docs for b in docs if a < b and docs[a] and docs[b] and len(docs[a] & docs[b]) >= 0.8 * len(docs[a] | docs[b])]
    want = groups(pairs, docs)
    assert {r.doc_id: (r.n_links, r.class_id) for r in queries.op9_jaccard_join(spark, small).collect()} == want


COLUMNS = {
    "op2_bpe_tree": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op3_token_counts": ["doc_id", "n_bytes", "n_tokens", "over_limit"],
    "op4_language": ["doc_id", "held_out", "lang_pred", "score"],
    "op5_quality": ["doc_id", "held_out", "score", "predicted"],
    "op6_nn_descent": ["vec_id", "n_links", "component_id", "kept"],
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_contract(spark, small, name):
    got = queries.QUERIES[name](spark, small)
    assert got.columns[:4] == COLUMNS[name]
    rows = got.collect()
    table = "embeddings" if name.startswith("op6") else "documents"
    assert len(rows) == spark.read.parquet(f"{small}/{table}.parquet").count()
    if "held_out" in got.columns:
        assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
