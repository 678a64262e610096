import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestone.llm import vector_dedup as V

DDL = "vec_id long, embedding array<float>, label int, node string, component int, n long"


def brute(rows, threshold=0.93):
    """(n_links, component_id) by all pairs."""
    ok = [r for r in rows if r[0] is not None and r[2] is not None and r[1] and None not in r[1] and np.isfinite(r[1]).all() and any(r[1])]
    top = list(range(len(ok)))
    n = [0] * len(ok)

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i in range(len(ok)):
        for j in range(i):
            a, b = np.asarray(ok[i][1], float), np.asarray(ok[j][1], float)
            if ok[i][2] == ok[j][2] and len(a) == len(b) and a @ b / np.sqrt((a @ a) * (b @ b)) >= threshold:
                n[i] += 1
                n[j] += 1
                p, q = find(i), find(j)
                if p != q:
                    if ok[p][0] < ok[q][0]:
                        top[q] = p
                    else:
                        top[p] = q
    return sorted((ok[k][0], n[k], ok[find(k)][0]) for k in range(len(ok)))


def clusters(seed, groups, width=16, noise=0.1):
    rng = np.random.default_rng(seed)
    rows, vec_id = [], 0
    for size, label in groups:
        center = rng.standard_normal(width)
        for _ in range(size):
            v = center + noise * rng.standard_normal(width)
            rows.append((vec_id, [float(np.float32(x)) for x in v], label))
            vec_id += 1
    order = rng.permutation(len(rows))
    return [(int(order[k]), *r[1:]) for k, r in enumerate(rows)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 7, 9) for r in rows], DDL)


@pytest.mark.parametrize("groups", [[(2, k % 3) for k in range(60)] + [(1, 0)] * 100, [(130, 1), (40, 1), (3, 2)] + [(1, 1)] * 60])
def test_against_all_pairs(spark, groups):
    rows = clusters(len(groups), groups)
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in V.links(frame(spark, rows), neighbours=6, largest=12, reverse=6, block=32).collect())
    assert got == brute(rows)


def test_odd_rows(spark):
    v = [1.0, 0.5, 0.25]
    rows = [(1, v, 0), (2, [2.0, 1.0, 0.5], 0), (3, v, 1), (4, v, None), (5, None, 0), (6, [], 0), (7, [0.0, 0.0, 0.0], 0), (8, [1.0, None, 2.0], 0), (9, [float("nan"), 1.0, 2.0], 0), (10, [float("inf"), 1.0, 2.0], 0), (None, v, 0), (12, v, 0), (12, v, 0), (13, [1.0, 0.5], 0)]
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in V.links(frame(spark, rows)).collect()), key=str)
    want = [(1, 3, 1, True), (2, 3, 1, False), (12, 3, 1, False), (12, 3, 1, False)] + [(k, 0, k, True) for k in (3, 4, 5, 6, 7, 8, 9, 10, 13)] + [(None, 0, None, None)]
    assert got == sorted(want, key=str)


def test_empty(spark):
    assert V.links(frame(spark, [])).count() == 0


def test_recall_on_a_table(spark):
    rows = [(r.vec_id, list(r.embedding), r.label) for r in spark.read.parquet("/root/testdata/check_s/embeddings.parquet").filter(F.col("label") == 3).collect()] if __import__("os").path.exists("/root/testdata/check_s") else clusters(5, [(2, 0)] * 300)
    got = {r.vec_id: r for r in V.links(frame(spark, rows)).collect()}
    x = np.array([r[1] for r in rows], float)
    x /= np.sqrt((x * x).sum(1, keepdims=True))
    n = (x @ x.T >= 0.93).sum(1) - 1
    assert sum(r.n_links for r in got.values()) >= 0.9 * n.sum()
    assert all(got[r[0]].n_links <= n[k] for k, r in enumerate(rows))


def hide(monkeypatch, start_of, rounds):
    """The first graph holds only what start_of(vector) says, and the first rounds add nothing."""
    first, step, calls = V.start, V.step, []

    def start(points, *rest):
        seen = [r.nid for r in points.select("nid", "vec").collect() if start_of(np.frombuffer(r.vec))]
        return first(points, *rest).filter(F.col("node").isin(seen) & F.col("other").isin(seen))

    def late(graph, points, *rest):
        calls.append(1)
        found = step(graph, points, *rest)
        return found.limit(0) if len(calls) <= rounds else found

    monkeypatch.setattr(V, "start", start)
    monkeypatch.setattr(V, "step", late)
    return calls


def test_pairs_beside_a_large_group_are_audited(spark, monkeypatch):
    rows = clusters(3, [(130, 0)] + [(2, 0)] * 20)
    by = {}
    for vec_id, v, _ in rows:
        by[vec_id] = np.array(v) / np.linalg.norm(v)
    x = np.array(list(by.values()))
    center = x[(x @ x.T >= 0.93).sum(1).argmax()]
    hide(monkeypatch, lambda v: v @ center / np.linalg.norm(v) >= 0.8, 99)
    audits = []
    audit = V.audit
    monkeypatch.setattr(V, "audit", lambda *rest: audits.append(audit(*rest)) or audits[-1])
    V.links(frame(spark, rows), neighbours=6, largest=12, reverse=6, rounds=1, block=32)
    assert audits[0][0] < 0.1


def test_signs_without_the_mean(spark):
    rng = np.random.default_rng(1)
    rows = [(k, (5 + rng.standard_normal(16)).tolist(), 0) for k in range(400)]
    _, points = V.nodes(frame(spark, rows), "vec_id", "embedding", "label")
    signs = np.array([r.signs for r in V.signed(points, 4).collect()])
    bits = (signs[:, :, None] >> np.arange(16)) & 1
    share = bits.reshape(400, -1).mean(0)
    assert 0.3 < share.min() and share.max() < 0.7


@pytest.mark.parametrize("groups,seen", [([(2, 0)] * 60 + [(1, 0)] * 20, 99), ([(130, 0)] + [(2, 0)] * 20, 99), ([(2, 0)] * 60, 3)])
def test_nothing_is_returned_below_the_target(spark, monkeypatch, groups, seen):
    """The rounds find no link: samples of four nodes, then an exact way."""
    rows = clusters(4, groups)
    hide(monkeypatch, lambda v: False, seen)
    audit = V.audit
    monkeypatch.setattr(V, "audit", lambda *rest, **more: audit(*rest, **more, audited=4, enough=4))
    monkeypatch.setattr(V, "SENT_BYTES", 10 * 16 * 8)
    monkeypatch.setattr(V, "SLICE", 7)
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in V.links(frame(spark, rows), neighbours=6, largest=12, reverse=6, rounds=1, block=32).collect())
    assert got == brute(rows)
