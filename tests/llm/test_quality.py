import math
import re

import numpy as np
import zstandard
from pyspark.sql import functions as F

from lodestone.llm import quality as Q


def test_held_out_accuracy(spark, small):
    d = small.replace("sf0.001", "sf0.01")
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    model = Q.fit(docs, labels)
    got = Q.score(docs, model).join(labels, "doc_id").filter("crc32(cast(doc_id as string)) % 5 = 0").toPandas()
    good = got.score >= Q.THRESHOLD
    assert (good == (got.quality == 1)).mean() >= 0.95
    assert got.score.between(0, 1).all()


def test_odd_rows(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(None, None), (-1, ""), (-2, "x"), (-2, "x"), (-3, "word " * 100000)], "doc_id long, text string")
    rows = docs.unionByName(odd).withColumns({"score": F.lit("s"), "quality": F.lit("q"), "__text": F.lit(5)})
    labels = spark.read.parquet(f"{small}/labels.parquet").select("doc_id", "quality").unionByName(spark.createDataFrame([(None, 1), (-2, None), (-3, 7)], "doc_id long, quality int"))
    model = Q.fit(rows, labels)
    got = Q.score(rows, model)
    assert got.count() == rows.count() and got.filter("score is null or score < 0 or score > 1").count() == 0
    empty = {r.score for r in got.filter("doc_id is null or doc_id = -1").collect()}
    assert empty == {model.share}
    kept = Q.keep(rows, model)
    assert kept.columns == rows.columns and kept.count() == got.filter(F.col("score") >= Q.THRESHOLD).count()
    assert {r["__text"] for r in kept.select("__text").distinct().collect()} == {5}


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in Q.score(docs, Q.fit(docs, none)).collect()} == {1.0}
    one = spark.createDataFrame([(k, 0) for k in range(20)], "doc_id long, quality int")
    assert {r.score for r in Q.score(docs, Q.fit(docs, one)).collect()} == {0.0}
    assert Q.score(docs.limit(0), Q.fit(docs.limit(0), none)).count() == 0


def test_logistic_converges_when_separable():
    x = np.hstack([np.linspace(-1, 1, 50)[:, None], np.ones((50, 1))])
    w = Q.logistic(x, (x[:, 0] > 0).astype(float), np.ones(50))
    assert np.isfinite(w).all() and w[0] > 1


def test_blocks_cover_whole_text():
    sizes = Q.Sizes(tuple(Q.dictionary([b"the and of " * 30]) for _ in range(4)))
    clean, junk = "the and of to in " * 3000, "%%% ### &&& " * 3000
    assert sizes.features(clean + junk)[2] != sizes.features(clean)[2]
    assert len(sizes.features("x" * (Q.BLOCK + 10))) == Q.Sizes.WIDTH and sizes.features(None) == [0.0] * Q.Sizes.WIDTH


def brute_score(model, text):
    """From the bytes of every block compressed anew by itself, number by number."""
    data = (text or "").encode()
    if not data:
        return model.share
    coder = lambda x: zstandard.ZstdCompressor(level=Q.LEVEL, dict_data=zstandard.ZstdCompressionDict(x, dict_type=zstandard.DICT_TYPE_FULLDICT if x[:4] == b"\x37\xa4\x30\xec" else zstandard.DICT_TYPE_RAWCONTENT), write_content_size=False, write_checksum=False, write_dict_id=False)
    kind = lambda c: "a" if c >= 128 or chr(c).islower() else "A" if chr(c).isupper() else "0" if chr(c).isdigit() else chr(c)
    rows = []
    for i in range(0, len(data), Q.BLOCK):
        block = data[i : i + Q.BLOCK]
        line = re.sub("(a)a+|(A)A+|(0)0+", lambda m: m[0][0], "".join(kind(c) for c in block)).encode("latin-1")
        good, bad, good_line, bad_line = (len(coder(x).compress(y)) for x, y in zip(model.dictionaries, (block, block, line, line)))
        rows.append([good - bad, good_line - bad_line, len(zstandard.ZstdCompressor(level=Q.LEVEL, write_content_size=False).compress(block)), len(line), len(block)])
    if len(rows) > 1 and rows[-1][4] < Q.BLOCK // 4:
        last = rows.pop()
        rows[-1] = [a + b for a, b in zip(rows[-1], last)]
    t = [sum(r[k] for r in rows) for k in range(5)]
    lines = [r[1] / r[3] for r in rows]
    x = [t[0] / len(data), t[1] / len(data), t[2] / len(data), t[1] / t[3], max(r[0] / r[4] for r in rows), max(lines), min(lines), min(r[2] / r[4] for r in rows), 200 / (200 + len(data))]
    z = [(a - m) / s for a, m, s in zip(x, model.mean, model.scale)]
    total = sum(a * w for a, w in zip([*z, *(a * a for a in z), 1], model.weights))
    return 1 / (1 + math.exp(-max(-30, min(30, total))))


def test_against_brute_force(spark, small):
    docs, labels = spark.read.parquet(f"{small}/documents.parquet"), spark.read.parquet(f"{small}/labels.parquet")
    model = Q.fit(docs, labels)
    got = {r.doc_id: r.score for r in Q.score(docs, model).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert model.weights and all(math.isclose(got[k], brute_score(model, texts[k]), rel_tol=1e-6, abs_tol=1e-9) for k in texts)
    kept = {r.doc_id for r in Q.keep(docs, model).collect()}
    assert kept == {k for k in texts if brute_score(model, texts[k]) >= Q.THRESHOLD} and 0 < len(kept) < len(texts)


def test_logistic_is_the_optimum():
    """The slope of the loss, written out, is zero where the fit ends."""
    rng = np.random.default_rng(3)
    x, weight = rng.normal(size=(200, 4)), rng.uniform(0.5, 2, 200)
    y = (x @ [1.0, -2.0, 0.5, 0.0] + rng.normal(size=200) > 0).astype(float)
    w = Q.logistic(x, y, weight)
    slope = sum(weight[k] * (1 / (1 + math.exp(-x[k] @ w)) - y[k]) * x[k] for k in range(200)) + 0.1 * w
    assert np.abs(slope).max() < 1e-4
