import random
import re

import pytest
from pyspark.sql import functions as F

from lodestone.llm import jaccard as J

DDL = "doc_id long, text string, key string, __jid int, component string"


LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def grams(text, size=5):
    """The n-grams of a text as tuples of words: written apart from the code under test."""
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return frozenset(tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))) if w else frozenset()


def brute(rows, threshold=0.8):
    sets = [grams(t) for _, t in rows]
    top, n = list(range(len(rows))), [0] * len(rows)
    place = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    order = {k: i for i, k in enumerate(place)}
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= threshold:
                n[i] += 1
                n[j] += 1
                p, q = find(i), find(j)
                if p != q:
                    a, b = sorted((p, q), key=order.get)
                    top[b] = a
    return sorted(((rows[k][0], n[k], rows[find(k)][0]) for k in range(len(rows))), key=str)


def corpus(seed, groups):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    rows = []
    for size in groups:
        base = [rng.choice(vocabulary) for _ in range(rng.randint(60, 140))]
        for _ in range(size):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(w)))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "k", 3, "c") for r in rows], DDL)


@pytest.mark.parametrize("groups", [[2] * 12 + [1] * 20, [45, 3, 1]])
def test_against_all_pairs(spark, groups):
    rows = corpus(sum(groups), groups)
    got = J.links(frame(spark, rows), block=8).collect()
    assert sorted(((r.doc_id, r.n_links, r.class_id) for r in got), key=str) == brute(rows)
    kept = J.dedup(frame(spark, rows), block=8)
    assert kept.columns == DDL.replace(" long", "").replace(" string", "").replace(" int", "").split(", ")
    assert sorted(r.doc_id for r in kept.collect()) == sorted({r.class_id for r in got})


def chain(n, step=3, width=60):
    """Texts that share most words with the next ones, and none with those further on: candidates in one chain."""
    w = [f"w{k}" for k in range(n * step + width)]
    return [(k, " ".join(w[k * step : k * step + width])) for k in range(n)]


def verified(spark, rows, block):
    bands, r = J.banding(0.8, J.RECALL, J.ROWS)
    signed = J.signatures(frame(spark, rows), "doc_id", "text", 5, bands, r)
    met = J.meetings(signed.select("bands", F.monotonically_increasing_id().alias("node")))
    component = J.connected_components(met.filter("node != hub"), "node", "hub")
    return J.units(met, component, block)


def test_chains_go_by_bucket(spark):
    rows = chain(200)
    got = J.links(frame(spark, rows), block=8).collect()
    assert sorted(((r.doc_id, r.n_links, r.class_id) for r in got), key=str) == brute(rows)
    sent = []
    for n in (200, 400):
        u = verified(spark, chain(n), 8).select("unit", "band", F.col("blocks").alias("k")).cache()
        assert u.filter("band < 0").count() == 0
        sent.append(u.agg(F.sum("k")).first()[0])
    assert sent[1] < 2.3 * sent[0] < 2.3 * 200 * 31 * 2


def test_copies_go_as_one_unit(spark):
    rows = corpus(3, [60])
    u = verified(spark, rows, 8).select("unit", "band", "node").collect()
    assert {r.band for r in u} == {-1} and len(u) == len({r.node for r in u})


def test_first_common_band():
    import numpy as np

    bands = np.array([[1, 2, 3], [1, 5, 3], [9, 2, 3], [7, 8, 9]])
    a, b = np.array([0, 0, 0, 1]), np.array([1, 2, 3, 2])
    for band, want in ((-1, [1, 1, 0, 1]), (0, [1, 0, 0, 0]), (1, [0, 1, 0, 0]), (2, [0, 0, 0, 1])):
        assert J.common_bands(bands, a, b, band).tolist() == [bool(x) for x in want]


def test_odd_rows(spark):
    text = "one two three four five six seven eight nine ten"
    rows = [(5, text), (5, text), (3, text.upper()), (None, text), (None, text), (7, None), (8, ""), (9, "?!"), (10, "a b"), (11, "A, b!"), (12, "word " * 50_000), (None, None), (13, "other words " * 3), (None, "alone with no id at all here"), (14, None)]
    got = sorted(((r.doc_id, r.n_links, r.class_id) for r in J.links(frame(spark, rows)).collect()), key=str)
    assert got == brute(rows)
    kept = sorted((r.doc_id for r in J.dedup(frame(spark, rows)).collect()), key=str)
    assert kept == sorted([3, 7, 8, 9, 10, 12, None, 13, None, 14], key=str)


def test_group_of_null_ids(spark):
    text = "one two three four five six seven eight nine ten"
    rows = [(None, text), (None, text), (None, text)]
    assert J.dedup(frame(spark, rows)).count() == 1
    assert [r.n_links for r in J.links(frame(spark, rows)).collect()] == [2, 2, 2]


def test_empty(spark):
    assert J.links(frame(spark, [])).count() == 0 and J.dedup(frame(spark, [])).count() == 0


def test_banding_reaches_recall():
    for t, recall, r in ((0.8, 0.9995, 6), (0.5, 0.99, 3)):
        bands, rows = J.banding(t, recall, r)
        assert 1 - (1 - t**rows) ** bands >= recall > 1 - (1 - t**rows) ** (bands - 1)


def test_shared_counts():
    rng = random.Random(4)
    sets = [J.n_grams(" ".join(rng.choice("abcd") for _ in range(rng.randint(1, 60)))) for _ in range(12)]
    import numpy as np

    at = np.arange(12)
    got = J.shared(sets, at[:5], at[5:])
    assert all(got[i, j] == len(set(sets[i].tolist()) & set(sets[5 + j].tolist())) for i in range(5) for j in range(7))


def test_filter_lets_all_wanted_through(spark):
    rows = corpus(9, [1] * 50)
    df = frame(spark, rows)
    wanted = df.filter("doc_id < 20").select(*J._address("doc_id", "text"))
    assert wanted.count() <= J.full_sets(df, wanted, "doc_id", "text", 5).count() <= 25
    assert J.full_sets(df, wanted.limit(0), "doc_id", "text", 5).count() == 0
    assert J.links(df, rows=6).filter(F.col("kept")).count() == 50
