import math
import random
import unicodedata
import zlib
from collections import Counter

from pyspark.sql import functions as F

from lodestone.llm import langid as G

DDL = "doc_id long, text string, lang string, score string, held_out int"


def test_words_first_then_n_grams():
    m = G.Model.learn([("en", "the", 9), ("en", "house", 3), ("de", "das", 9), ("de", "haus", 3)])
    assert m.predict("the the house")[0] == "en" and m.predict("das Haus")[0] == "de"
    assert m.predict("houses")[0] == "en" and m.predict("hausen")[0] == "de"
    assert m.predict(None) == ("und", 0.0) and m.predict("12 !?") == ("und", 0.0)
    assert 0.5 < m.predict("the")[1] <= 1
    assert m.predict("the " * 20000)[0] == "en"


def test_bounded_memory(monkeypatch):
    monkeypatch.setattr(G, "CACHE_BYTES", 3 * 4 * 2)
    counts = [("en", "the", 9), ("de", "das", 9)]
    m = G.Model.learn(counts)
    words = ["thex", "thexx", "dasx", "dasxx", "thy", "thz", "dax"]
    assert [m.predict(" ".join(words))[0] for _ in range(3)] == ["en"] * 3 and len(m._logs) == 3
    assert [m.predict(w)[0] for w in words] == [G.Model.learn(counts).predict(w)[0] for w in words]


def test_letters_alone_make_words():
    """Numbers that aren't digits, marks and signs are no letters: such a text has no language."""
    m = G.Model.learn([("en", "the", 9), ("de", "das", 9)])
    for text in ("\u00bd \u00b2 \u2167 \u2460", "\u0661\u0662", "_ __", "\u0301\u0903", "12\u00bd"):
        assert m.predict(text) == ("und", 0.0)
    for c in map(chr, range(0x30000)):
        assert G.words_of(c).total() == (unicodedata.category(c.lower()[0])[0] == "L"), hex(ord(c))
    assert G.words_of("ab\u00bdc d\u00b2 ab") == {"ab": 2, "c": 1, "d": 1}


def brute(rows, texts):
    """Words first, n-grams for the others: dictionaries and loops only."""
    cut_words = lambda t: "".join(c if unicodedata.category(c)[0] == "L" else " " for c in (t or "").lower()).split()
    grams = lambda w, k: list(w) if k == 1 else [f"^{w}$"[i : i + k] for i in range(len(w) + 3 - k)]
    langs = sorted({x for _, x, _ in rows})
    tables = {k: {x: Counter() for x in langs} for k in ("word", 1, 2, 3, 4, 5)}
    for _, lang, text in rows:
        for w in cut_words(text):
            tables["word"][lang][w] += 1
            for k in (1, 2, 3, 4, 5):
                tables[k][lang].update(grams(w, k))
    names = {k: {w for c in t.values() for w in c} for k, t in tables.items()}

    def log(k, lang, w):
        return math.log((tables[k][lang][w] + 0.5) / (sum(tables[k][lang].values()) + 0.5 * len(names[k])))

    def of(w, lang):
        if w in names["word"]:
            return log("word", lang, w)
        for k in (5, 4, 3, 2, 1):
            found = [g for g in grams(w, k) if g in names[k]]
            if found:
                return sum(log(k, lang, g) for g in found) / len(found) * max(1, (len(w) + 2) / k) / 2
        return 0.0

    out = []
    for text in texts:
        w = cut_words(text)
        if not w:
            out.append(("und", 0.0))
            continue
        total = [sum(of(x, lang) for x in w) for lang in langs]
        best = total.index(max(total))
        out.append((langs[best], 1 / sum(math.exp(max(-700, x - total[best])) for x in total)))
    return out


def test_against_brute_force(spark):
    rng = random.Random(5)
    vocabulary = {"aa": "sun moon house river tree water stone bread", "bb": "sonne mond haus fluss baum wasser stein brot", "cc": "\u65e5\u672c\u8a9e \u6587\u7ae0 \u6c34"}
    rows = [(k, lang := rng.choice([*vocabulary]), " ".join(rng.choice(vocabulary[lang].split()) for _ in range(12))) for k in range(60)]
    texts = [" ".join(rng.choice([*" ".join(vocabulary.values()).split(), "sonnen", "houses", "zzz", "\u672c\u8a9e\u6c34", "\u00bd", "Fl\u00fcsse"]) for _ in range(rng.randint(0, 6))) for _ in range(80)] + [None, "", "?!"]
    learnt = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5]
    model = G.fit(spark.createDataFrame([(k, t, x, "", 0) for k, x, t in rows], DDL))
    got = G.predict(spark.createDataFrame([(k, t, None, "", 0) for k, t in enumerate(texts)], DDL), model).collect()
    want = brute(learnt, texts)
    assert [r.lang_pred for r in sorted(got, key=lambda r: r.doc_id)] == [x for x, _ in want]
    assert all(math.isclose(r.score, want[r.doc_id][1], rel_tol=1e-4, abs_tol=1e-9) for r in got)


def test_rows(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text", "lang")
    odd = spark.createDataFrame([(None, None, None, "", 0), (10**6, "", "en", "", 0), (10**6, "123", None, "", 0), (10**6, "123", None, "", 0)], DDL).select("doc_id", "text", "lang")
    rows = docs.unionByName(odd).withColumns({"score": F.lit("x"), "lang_pred": F.lit(1)})
    model = G.fit(rows)
    got = G.predict(rows, model)
    assert got.count() == rows.count() and got.filter("lang_pred = 'und' and score = 0").count() >= 4
    right = docs.join(got, "doc_id").filter("crc32(cast(doc_id as string)) % 5 = 0 and lang is not null")
    assert right.filter("lang = lang_pred").count() >= 0.95 * right.count()
    assert got.filter("score < 0 or score > 1 or score is null").count() == 0


def test_held_out_rows_teach_nothing(spark):
    data = [(k, "same words here", "aa" if zlib.crc32(str(k).encode()) % 5 == 0 else "bb", "", 0) for k in range(100)]
    assert G.fit(spark.createDataFrame(data, DDL)).langs == ["bb"]


def test_nothing_to_learn(spark):
    none = spark.createDataFrame([], DDL)
    m = G.fit(none)
    assert m.langs == [] and m.predict("the house") == ("und", 0.0) and G.predict(none, m).count() == 0
    df = spark.createDataFrame([(1, "abc", None, "", 0)], DDL)
    assert [tuple(r) for r in G.predict(df, G.fit(df)).collect()] == [(1, "und", 0.0)]


def test_a_small_language_beside_a_large_one(spark):
    """The bound on words is shared out, and runs without spaces teach their n-grams."""
    large = [(k, " ".join(f"{a}{b}" for a in "bcdfg" for b in "aeiou") + f" b{'ae'[k % 2]}", "aa", "", 0) for k in range(200)]
    small = [(1000 + k, "\u65e5\u672c\u8a9e\u306e\u6587" * 14 + chr(0x4E00 + k), "zz", "", 0) for k in range(8)]
    model = G.fit(spark.createDataFrame(large + small, DDL), most_words=20)
    assert model.langs == ["aa", "zz"] and len(model.words.place) <= 20
    assert model.predict("\u672c\u8a9e\u306e")[0] == "zz" and model.predict("ba be")[0] == "aa"


def test_very_many_languages(spark):
    """No language is left out for there being others, and the model doesn't grow with their square."""
    data = [(k, f"{'abcdefghij'[k % 10]}{'klmnopqrst'[k // 10 % 10]}{'uvwxyzabcd'[k // 100 % 10]}x", f"l{k % 1000}", "", 0) for k in range(5000)]
    model = G.fit(spark.createDataFrame(data, DDL))
    assert len(model.langs) == 1000 and len(model.words.lang) == 1000
    assert model.predict("akux")[0] == "l0" and model.predict("jtdx")[0] == "l999"
