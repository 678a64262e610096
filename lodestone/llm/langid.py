"""Language identification, words first.

Each word that is known from learning adds its log frequency in every language. A word that isn't backs off to
its character n-grams, the longest known order first, then ever shorter ones, and adds their mean log
frequencies, weighted by how much of the word they stand for. The highest sum names the language; its share
among all (softmax) is the score.

Learning uses rows outside of the held-out fold with a language: about PER_LANG rows of each language, chosen by a
hash of their id, SAMPLE_CHARS characters of each at most (evenly spaced parts of longer ones). Of that sample each
language keeps its most frequent words, of under LONGEST characters, up to an equal share of MOST_WORDS, and of the
n-grams of all its runs of letters, also of longer ones and those seen once, the most frequent of each order up to
an equal share of MOST_GRAMS (one of each at least): so the model is bounded whatever the size of the input, and no
language takes another's place. Frequencies are kept for the languages that have a word only, so many languages
make no large model. Learning and prediction take the same words: runs of letters, that is of the characters of
the general category L, in lower case. Every text is predicted whole.

Null and empty texts and those without a letter are `und` with score 0; so is every text if there is nothing to
learn from. Ties go to the language that sorts first. Repeated rows give repeated results; an empty table gives
an empty result. Columns other than the named ones are ignored, and lang is read in learning only.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterable
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, cut, field, held_out, sampled, spread, texts

PER_LANG, SAMPLE_CHARS, MOST_WORDS, MOST_GRAMS, LONGEST, ORDERS, NONE = 1500, 16_384, 200_000, 500_000, 64, (5, 4, 3, 2, 1), "und"
CACHE_BYTES = 20_000_000  # of logs of unknown words that a worker remembers


WORD = re.compile(r"[^\W\d_]+")  # letters, and numbers that are no digits, such as one half


def words_of(text: str | None) -> Counter:
    """The runs of letters of the text in lower case, with how often they occur."""
    found = Counter(WORD.findall((text or "").lower()))
    for mixed in [w for w in found if not w.isalpha()]:
        n = found.pop(mixed)
        for w in "".join(c if c.isalpha() else " " for c in mixed).split():
            found[w] += n
    return found


class Table:
    """Smoothed log frequencies of words by language: base for those that a language doesn't have, and for each
    word the languages that do, with what these add to the base."""

    def __init__(self, counts: Iterable[tuple[int, str, int]], langs: int):
        rows = sorted(counts, key=lambda x: (x[1], x[0]))
        self.lang = np.array([x[0] for x in rows], np.int32)
        n = np.array([x[2] for x in rows], np.float64)
        new = [k for k, x in enumerate(rows) if not k or x[1] != rows[k - 1][1]]
        self.place = {rows[k][1]: i for i, k in enumerate(new)}
        self.start = np.array([*new, len(rows)], np.int64)
        total = np.bincount(self.lang, n, langs) + 0.5 * len(new)
        self.base = np.log(0.5 / np.maximum(total, 0.5))
        self.more = (np.log(n + 0.5) - np.log(0.5)).astype(np.float32)

    @cached_property
    def lists(self) -> tuple[list[int], list[int], list[float], list[float]]:
        """start, lang, more and base as lists, which are faster than arrays for a few numbers."""
        return self.start.tolist(), self.lang.tolist(), self.more.tolist(), self.base.tolist()

    def mean(self, places: list[int], weight: float) -> list[float]:
        """The mean, by language and times weight, of the logs of a few words."""
        start, lang, more, base = self.lists
        out, share = [x * weight for x in base], weight / len(places)
        for k in places:
            for j in range(start[k], start[k + 1]):
                out[lang[j]] += more[j] * share
        return out

    def total(self, places: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """The weighted sum, by language, of the logs of the words at places."""
        start = self.start[places]
        n = self.start[places + 1] - start
        at = np.repeat(start - np.cumsum(n) + n, n) + np.arange(n.sum())
        return np.bincount(self.lang[at], self.more[at] * np.repeat(weights, n), len(self.base)) + weights.sum() * self.base


@dataclass
class Model:
    langs: list[str]
    words: Table
    grams: dict[int, Table]

    @staticmethod
    def learn(counts: list[tuple[str, str, int]], counted: list[tuple[str, str, int]] | None = None) -> Model:
        """From (language, word, occurrences), and such of n-grams; without these they come from the words."""
        counted = gram_counts(counts) if counted is None else counted
        langs = sorted({x[0] for x in [*counts, *counted]})
        place = {x: k for k, x in enumerate(langs)}
        orders = defaultdict(list)
        for lang, gram, n in counted:
            orders[len(gram)].append((place[lang], gram, n))
        return Model(langs, Table(((place[x], w, n) for x, w, n in counts), len(langs)), {k: Table(x, len(langs)) for k, x in orders.items()})

    def back_off(self, word: str) -> list[float]:
        for order in ORDERS:
            if order in self.grams:
                table = self.grams[order]
                found = [table.place[g] for g in n_grams(word, order) if g in table.place]
                if found:
                    return table.mean(found, max(1.0, (len(word) + 2) / order) / 2)
        return [0.0] * len(self.langs)

    def unknown(self, words: dict[str, int]) -> np.ndarray:
        """The weighted sum of the logs of unknown words, which are remembered as far as CACHE_BYTES reach."""
        if not hasattr(self, "_seen"):
            self._seen: dict[str, int] = {}
            self._logs = np.zeros((max(1, CACHE_BYTES // (4 * len(self.langs))), len(self.langs)), np.float32)
        out, rows, n = np.zeros(len(self.langs)), [], []
        for word, k in words.items():
            row = self._seen.get(word)
            if row is None:
                if len(self._seen) == len(self._logs):
                    out += np.array(n, np.float64) @ self._logs[rows]
                    rows, n = [], []
                    self._seen.clear()
                row = self._seen[word] = len(self._seen)
                self._logs[row] = self.back_off(word)
            rows.append(row)
            n.append(k)
        return out + np.array(n, np.float64) @ self._logs[rows]

    def predict(self, text: str | None) -> tuple[str, float]:
        counts = words_of(text)
        if not counts or not self.langs:
            return NONE, 0.0
        place = [*map(self.words.place.get, counts)]
        rows, n = np.array([-1 if k is None else k for k in place]), np.fromiter(counts.values(), np.float64, len(counts))
        total = self.words.total(rows[rows >= 0], n[rows >= 0])
        if None in place:
            total = total + self.unknown({w: c for (w, c), k in zip(counts.items(), place, strict=True) if k is None})
        best = int(total.argmax())
        return self.langs[best], float(1 / np.exp(np.clip(total - total[best], -700, 0)).sum())


def n_grams(word: str, order: int) -> list[str]:
    """Character n-grams of the word with its ends marked; single characters without the marks."""
    if order == 1:
        return list(word)
    marked = f"^{word}$"
    return [marked[k : k + order] for k in range(len(marked) - order + 1)]


def gram_counts(counts: Iterable[tuple[str, str, int]]) -> list[tuple[str, str, int]]:
    """(language, n-gram, occurrences) of (language, word, occurrences)."""
    found: Counter = Counter()
    for lang, word, n in counts:
        for order in ORDERS:
            for gram in n_grams(word, order):
                found[lang, gram] += n
    return [(*x, n) for x, n in found.items()]


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 5, per_lang: int = PER_LANG, most_words: int = MOST_WORDS, most_grams: int = MOST_GRAMS) -> Model:
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out("doc_id", folds))
    rows = sampled(rows, F.concat(F.col("doc_id").cast("string"), F.lit(":lang")), "lang", per_lang)
    bounded_batches(docs.sparkSession)

    def batch_of(found: Iterable[tuple[str, str, int]], name: str) -> pa.RecordBatch:
        columns = [*zip(*found, strict=True)] or [(), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.string(), pa.string(), pa.int64()), strict=True)], ["lang", name, "n"])

    def by_word(batches):
        for batch in batches:
            found: Counter = Counter()
            for lang, text in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                for word, n in words_of(text).items():
                    found[lang, word] += n
            yield batch_of(((*x, n) for x, n in found.items()), "word")

    def by_gram(batches):
        for batch in batches:
            yield batch_of(gram_counts(zip(*(x.to_pylist() for x in batch.columns), strict=True)), "gram")

    def summed(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy("lang", name).agg(F.sum("n").alias("n"))

    def frequent(rows: DataFrame, name: str, most: int, *keys) -> list[tuple]:
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("n"), name))
        return [tuple(r) for r in rows.withColumn("rank", rank).filter(F.col("rank") <= most).select("lang", name, "n").orderBy("lang", name).collect()]

    counts = cut(summed(rows.select("lang", spread(F.col("text"), SAMPLE_CHARS).alias("text")).mapInArrow(by_word, "lang string, word string, n long"), "word"))
    # tables of most_words and most_grams rows at most, or one for each language, reach the driver
    langs = max(1, counts.select("lang").distinct().count())
    grams = summed(counts.mapInArrow(by_gram, "lang string, gram string, n long"), "gram")
    top = frequent(counts.filter(F.length("word") < LONGEST), "word", max(1, most_words // langs), "lang")
    return Model.learn(top, frequent(grams, "gram", max(1, most_grams // (langs * len(ORDERS))), "lang", F.length("gram")))


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) for every row, from its whole text alone."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # MOST_WORDS words and MOST_GRAMS n-grams at most

    def run(batches):
        for batch in batches:
            found = [sent.value.predict(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())], ["doc_id", "lang_pred", "score"])

    schema = T.StructType([field(docs, id_col, "doc_id"), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return texts(docs, id_col, text_col).mapInArrow(run, schema)
