import random
import re

import duckdb

import corpus_pipeline
from lodestone.llm import decontam as D
from lodestone.llm import queries

DDL = "doc_id long, text string, n_words string, items int, __text string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, bench, width):
    out = []
    for doc, text in docs:
        w, hit, items = split(text), set(), set()
        for item, item_text in bench:
            b = split(item_text)
            for k in range(max(1, len(b) - width + 1) if b else 0):
                win = b[k : k + width]
                for p in range(len(w) - len(win) + 1):
                    if w[p : p + len(win)] == win:
                        hit.update(range(p, p + len(win)))
                        items.add(str(item))
        out.append((doc, len(w), len(hit), sorted(items), bool(hit)))
    return out


def frames(spark, docs, bench):
    return spark.createDataFrame([(*d, "x", 5, "keep") for d in docs], DDL), spark.createDataFrame(bench, "item_id long, text string")


def sample(seed):
    rng = random.Random(seed)
    vocabulary = ["a", "B", "c", "é", "d1", "Zz"]
    text = lambda n: "".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "-", "\n"]) for _ in range(n))
    bench = [(k, text(rng.choice([0, 1, 2, 5, 9]))) for k in range(8)] + [(3, text(4)), (9, None), (None, "a b")]
    docs = [(k, text(rng.randint(0, 60))) for k in range(40)]
    docs += [(50, (bench[7][1] or "a") * 3), (50, (bench[7][1] or "a") * 3), (51, None), (52, ""), (None, text(30))]
    return docs, bench


def test_against_brute_force(spark):
    for seed in range(4):
        docs, bench = sample(seed)
        d, b = frames(spark, docs, bench)
        known = [(k, t) for k, t in bench if k is not None]
        want = sorted(brute(docs, known, 4), key=str)
        for shard, most in ((1, 10**6), (10**6, 8)):
            got = sorted((tuple(r) for r in D.annotate(d, b, width=4, shard_words=shard, most_bytes=most).collect()), key=str)
            assert got == want
        kept = D.clean(d, b, width=4)
        assert kept.columns == d.columns
        assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted((w[0] for w in want if not w[4]), key=str)
        assert {r["__text"] for r in kept.collect()} == {"keep"}


def test_longest_matches(spark):
    d, b = frames(spark, [(1, "x x one two three four five six y one two three four z")], [(7, "one two three four five six seven"), (8, "nothing of this kind at all")])
    got = [tuple(r) for r in D.matches(d, b, width=3).collect()]
    assert sorted(got) == [(1, "7", 0, 2, 6), (1, "7", 0, 9, 4)]


def test_matches_belong_to_the_text_of_one_row(spark):
    """An item id may stand for several texts: no match joins words of two of them."""
    d, b = frames(spark, [(1, "a b c d e f"), (2, "x y z d e f")], [(7, "a b c"), (7, "x y z d e f"), (7, "a b c"), (8, "a b c")])
    assert sorted(tuple(r) for r in D.matches(d, b, width=3).collect()) == [(1, "7", 0, 0, 3), (1, "7", 0, 0, 3), (1, "7", 3, 3, 3), (1, "8", 0, 0, 3), (2, "7", 0, 0, 6)]
    assert {(r.doc_id, r.n_hit, tuple(r["items"])) for r in D.annotate(d, b, width=3).collect()} == {(1, 6, ("7", "8")), (2, 6, ("7",))}


def test_merged_in_slices(monkeypatch):
    docs, bench = sample(2)
    windows, found = D.Windows([([str(k)], t) for k, t in dict(bench).items() if t], 4), [D.words(t) for _, t in docs]

    def runs():
        return sorted(x for part in D._located(windows, found)[0] for x in zip(*(y.tolist() for y in part), strict=True))

    whole = runs()
    for n in (1, 3, 17):
        monkeypatch.setattr(D, "AT_ONCE", n)
        assert runs() == whole and whole


def test_very_long_text(spark):
    """One text of 400,000 words that holds a passage far inside, and many times."""
    passage = " ".join(f"p{k}" for k in range(15))
    long = " ".join(f"w{k % 5000}" for k in range(200_000)) + f" {passage} " + " ".join(f"v{k % 7}" for k in range(200_000))
    d, b = frames(spark, [(1, long), (2, f"{passage} " * 2000)], [(5, passage)])
    got = {r.doc_id: (r.n_words, r.n_hit) for r in D.annotate(d, b).collect()}
    assert got == {1: (400_015, 15), 2: (30_000, 30_000)}
    assert D.matches(d, b).filter("doc_id = 1").collect()[0].doc_word == 200_000


def test_what_is_sent_is_bounded():
    rng = random.Random(1)
    items = [([str(k)], " ".join(f"w{rng.randrange(50_000)}" for _ in range(200))) for k in range(100)]
    w = D.Windows(items)
    assert w.n_bytes() <= 100 * 200 * (4 * w.width + 64) and len(__import__("pickle").dumps(w)) < 1.5 * w.n_bytes()


def test_more_than_256_words(spark):
    """Numbers of words whose last byte is zero."""
    bench = [(1, " ".join(f"w{k}" for k in range(600)))]
    docs = [(k, " ".join(f"w{i}" for i in range(k, k + 12))) for k in range(240, 262)]
    d, b = frames(spark, docs, bench)
    assert sorted(tuple(r) for r in D.annotate(d, b).collect()) == sorted(brute(docs, bench, 10))


def test_empty_tables(spark):
    d, b = frames(spark, [(1, "a b")], [])
    assert [tuple(r) for r in D.annotate(d, b).collect()] == [(1, 2, 0, [], False)]
    assert D.clean(d, b).count() == 1 and D.annotate(d.limit(0), b).count() == 0 and D.matches(d, b).count() == 0


def test_items_without_an_id_as_in_the_sql(spark, tmp_path):
    docs, bench = sample(5)
    bench += [(None, "x1 x2 x3"), (4, "x1 x2 x3"), (None, None)]
    docs += [(60, "a x1 x2 x3 b"), (61, bench[7][1])]
    d, b = frames(spark, docs, bench)
    for name, df in (("documents", d), ("benchmark", b)):
        df.coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    c = duckdb.connect()
    for name in ("documents", "benchmark"):
        c.sql(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    # repeated and null ids are joined by the SQL, which is about one row per id
    c.sql("CREATE OR REPLACE TABLE once AS SELECT doc_id, any_value(text) AS text FROM documents WHERE doc_id IS NOT NULL GROUP BY doc_id")
    sql = c.sql(queries.ORACLE["op7_decontamination"].replace("FROM documents", "FROM once"))
    got = queries.op7_decontamination(spark, str(tmp_path)).filter("doc_id is not null").distinct()
    assert sorted(tuple(r[x] for x in sql.columns) for r in got.collect()) == sorted(sql.fetchall())
    hit = {r[0] for r in sql.fetchall() if r[-1]}
    kept = corpus_pipeline.without_benchmark(spark, d, str(tmp_path)).filter("doc_id is not null")
    assert {r.doc_id for r in kept.collect()} == {k for k, _ in docs if k is not None} - hit and hit


def test_words_hit_are_those_of_the_longest_matches(spark):
    docs, bench = sample(6)
    d, b = frames(spark, [x for x in docs if x[0] not in (None, 50)], bench)
    covered = {}
    for doc, _, _, at, n in (tuple(r) for r in D.matches(d, b, width=4).collect()):
        covered.setdefault(doc, set()).update(range(at, at + n))
    got = {r.doc_id: r.n_hit for r in D.annotate(d, b, width=4).collect()}
    assert got == {k: len(covered.get(k, ())) for k in got} and covered
