"""N-gram Jaccard join by MinHash banding, verified on full n-gram sets.

Every text becomes its set of word n-grams (words as in the decontamination operator; a text of fewer words,
but not none, is one n-gram). Texts with equal sets form a class, so copies are one member from here on. The
numbers of bands and rows are chosen so that a pair at the threshold shares a band with the probability
`recall`; classes meet where the hash of a whole band is equal. The full sets of those that meet are fetched again,
and every pair that shares a band is verified exactly, once, block against block inside of a task, which returns
numbers of links and the edges of a spanning forest, never pairs. Groups are components of these links.

What is verified doesn't depend on how it is dealt out, and that is chosen by cost. The pairs of a bucket are
checked in the bucket of their first common band. Where many buckets hold the same rows again and again (a group of
copies), their whole component goes through as one unit instead, in which the pairs without a common band are
skipped. Each component takes the way that sends fewer sets, so chains of half-alike texts cost as much as
their buckets, however long they get, and groups of copies no more than their blocks.

links() returns a row for every row: its class, its group of linked documents and how many other documents it is
linked to (copies count, each for itself). dedup() keeps the document with the smallest id of each group.

Null and empty texts, and those without words, link to nothing. Rows with a null id link like others; they
count, they are never the smallest id of a group that has another, and of a group of null ids one row stays.
Repeated rows are copies of each other; dedup() leaves one of them. An empty table gives an empty result. Other
columns, whatever their names, are ignored by links() and kept untouched by dedup().

To fetch the sets of candidates without a shuffle of all texts, rows are first tested against a Bloom filter of
at most MOST_BITS bits; beyond what it can hold it only lets more rows through to the exact join.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, cut, field, fresh, split_join
from .components import by_cell, connected_components, forest
from .decontam import words

SIZE, THRESHOLD, RECALL, ROWS, BLOCK, MOST_BITS, PROBES = 5, 0.8, 0.9999, 6, 512, 1 << 26, 3


def banding(threshold: float = THRESHOLD, recall: float = RECALL, rows: int = ROWS) -> tuple[int, int]:
    """(bands, rows): as few bands of that many rows as find a pair at the threshold with probability recall."""
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))), rows


class Hashes(dict):
    """64-bit hashes of words, remembered."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > 100_000:
            self.clear()
        self[word] = out = xxhash.xxh3_64_intdigest(word)
        return out


@lru_cache(maxsize=1)
def hashes() -> Hashes:
    return Hashes()


def n_grams(text: str | None, size: int = SIZE) -> np.ndarray:
    """The sorted hashes of the distinct n-grams of the text."""
    found = words(text)
    if not found:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes().__getitem__, found), np.uint64, len(found))
    width = min(size, len(h))
    out = np.full(len(h) - width + 1, len(h) if len(h) < size else size, np.uint64)
    for k in range(width):
        out = (out ^ h[k : len(h) - width + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return np.unique(out ^ (out >> np.uint64(32)))


def band_hashes(grams: np.ndarray, bands: int, rows: int) -> list[int]:
    """A hash of each band of the MinHash signature of a set that isn't empty."""
    import xxhash

    factors = np.random.default_rng(20240229).integers(1, 1 << 63, bands * rows, np.uint64) * np.uint64(2) + np.uint64(1)
    least = np.full(bands * rows, np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(grams), 512):
        x = grams[k : k + 512, None] * factors
        least = np.minimum(least, (x ^ (x >> np.uint64(31))).min(0))
    signature = least.reshape(bands, rows)
    return [xxhash.xxh3_64_intdigest(signature[k].tobytes(), seed=k) - (1 << 63) for k in range(bands)]


def _key(grams: np.ndarray) -> bytes:
    import xxhash

    return xxhash.xxh3_128_digest(grams.tobytes())


def _address(id_col: str, text_col: str) -> list[Column]:
    """What names a row in another pass over the same rows: its id as text and a hash of its text."""
    return [F.coalesce(F.col(id_col).cast("string"), F.lit("~")).alias("jid"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("jhash")]


def signatures(docs: DataFrame, id_col: str, text_col: str, size: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, jid, jhash, key, bands) of every row; key is null without words. Computed once."""

    def run(batches):
        for batch in batches:
            keys, found = [], []
            for text in batch.column(3).to_pylist():
                grams = n_grams(text, size)
                keys.append(_key(grams) if len(grams) else None)
                found.append(band_hashes(grams, bands, rows) if len(grams) else None)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(keys, pa.binary()), pa.array(found, pa.list_(pa.int64()))], ["doc_id", "jid", "jhash", "key", "bands"])

    bounded_batches(docs.sparkSession)
    schema = T.StructType([field(docs, id_col, "doc_id"), T.StructField("jid", T.StringType()), T.StructField("jhash", T.LongType()), T.StructField("key", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType()))])
    return cut(docs.select(F.col(id_col).alias("doc_id"), *_address(id_col, text_col), F.col(text_col).alias("text")).mapInArrow(run, schema))


def bloom(hashed: DataFrame) -> np.ndarray:
    """A Bloom filter over the longs of column h, as 64-bit words; MOST_BITS at most reach the driver."""
    n = hashed.count()
    bits = min(MOST_BITS, max(1 << 10, 1 << (16 * n).bit_length()))
    places = F.transform(F.array(*[F.lit(k) for k in range(PROBES)]), lambda k: F.pmod(F.xxhash64(F.col("h"), k), F.lit(bits)))
    found = hashed.select(F.explode(places).alias("p")).select(F.shiftright("p", 6).alias("w"), F.expr("shiftleft(1L, cast(p & 63 as int))").alias("b"))
    out = np.zeros(bits >> 6, np.int64)
    for batch in found.groupBy("w").agg(F.bit_or("b").alias("b")).toArrow().to_batches():
        out[batch["w"].to_numpy()] = batch["b"].to_numpy()
    return out


def full_sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """(key, grams) for the rows of docs that wanted (jid, jhash) names, and a few others."""
    name = F.xxhash64("jid", "jhash")
    filter_ = docs.sparkSession.sparkContext.broadcast(bloom(wanted.select(name.alias("h"))))  # MOST_BITS at most
    bits = len(filter_.value) << 6

    def run(batches):
        words_ = filter_.value
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            for k in range(PROBES):
                p = batch.column(k).to_numpy(zero_copy_only=False)
                keep &= (words_[p >> 6] >> (p & 63)) & 1 == 1
            sets = [n_grams(x, size) for x in batch.column(PROBES).filter(pa.array(keep)).to_pylist()]
            sets = [x for x in sets if len(x)]
            yield pa.RecordBatch.from_arrays([pa.array([_key(x) for x in sets], pa.binary()), pa.array([x.tobytes() for x in sets], pa.binary())], ["key", "grams"])

    rows = docs.select(*_address(id_col, text_col), F.col(text_col).alias("text")).withColumn("h", name)
    probes = [F.pmod(F.xxhash64("h", F.lit(k)), F.lit(bits)).alias(f"p{k}") for k in range(PROBES)]
    return rows.select(*probes, "text").mapInArrow(run, "key binary, grams binary")


def shared(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Numbers of common n-grams of the sets at places left (rows) with those at places right (columns)."""
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, gram, n = np.unique(flat, return_inverse=True, return_counts=True)
    often = n[gram] > 1
    _, gram = np.unique(gram[often], return_inverse=True)
    owner = owner[often]
    out = np.zeros((len(left), len(right)), np.float32)
    order = np.argsort(gram, kind="stable")
    gram, owner = gram[order], owner[order]
    width = 4096
    for start in range(0, int(gram[-1]) + 1 if len(gram) else 0, width):
        a, b = np.searchsorted(gram, [start, start + width])
        m = np.zeros((len(sets), width), np.float32)
        m[owner[a:b], gram[a:b] - start] = 1
        out += m[left] @ m[right].T
    return out


def common_bands(bands: np.ndarray, left: np.ndarray, right: np.ndarray, band: int) -> np.ndarray:
    """Which pairs (left[k], right[k]) count here: those whose first common band is `band`, or any if that is -1."""
    out = np.zeros(len(left), bool)
    for k in range(0, len(left), 65_536):
        same = bands[left[k : k + 65_536]] == bands[right[k : k + 65_536]]
        out[k : k + 65_536] = same.any(1) & ((same.argmax(1) == band) | (band < 0))
    return out


def verify(threshold: float):
    """For by_cell: (node, links, other): how many documents each class of the cell links to, and forest edges."""

    def run(cell: pa.Table):
        i, j, band = (cell[x][0].as_py() for x in ("__i", "__j", "band"))
        keys, block, n = cell["node"].to_pylist(), np.array(cell["block"].to_pylist()), np.array(cell["n"].to_pylist(), np.int64)
        sets = [np.frombuffer(x, np.uint64) for x in cell["grams"].to_pylist()]
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        if not len(left) or not len(right) or len(keys) < 2:
            return
        size = np.array([len(x) for x in sets], np.float64)
        common = shared(sets, left, right).astype(np.float64)
        linked = common >= threshold * (size[left][:, None] + size[right][None, :] - common) - 1e-9
        if i == j:
            np.fill_diagonal(linked, False)
        a, b = np.nonzero(linked)
        linked[a, b] = common_bands(np.array(cell["bands"].to_pylist(), np.int64), left[a], right[b], band)
        a, b = np.nonzero(linked)
        links = np.zeros(len(keys), np.int64)
        links[left] += linked @ n[right]
        if i != j:
            links[right] += n[left] @ linked
        rows = [(keys[k], int(links[k]), None) for k in np.flatnonzero(links)]
        rows += [(keys[x], 0, keys[y]) for x, y in forest(len(keys), left[a], right[b])]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(3)], ["node", "links", "other"])

    return run


def meetings(classes: DataFrame) -> DataFrame:
    """(bucket, node, band, hub, last, m, x) of the classes in buckets of two or more: the bucket's smallest and
    largest node, its number of nodes and a hash of them all. Computed once."""
    met = classes.select("node", F.posexplode("bands").alias("band", "hash")).select("node", "band", F.xxhash64("band", "hash").alias("bucket"))
    sums = met.groupBy("bucket").agg(F.min("node").alias("hub"), F.max("node").alias("last"), F.count("*").alias("m"), F.bit_xor(F.xxhash64("node")).alias("x")).filter("hub != last")
    return cut(split_join(met, sums, "bucket"))


def units(met: DataFrame, component: DataFrame, block: int) -> DataFrame:
    """(node, unit, band, blocks, block): what is verified together, a whole component (band -1) or a bucket, each
    in blocks. Of buckets with the same nodes that of the lowest band stands for all."""
    cost = lambda x: F.col(x) * F.ceil(F.col(x) / block)
    sizes = component.groupBy("component").agg(F.count("*").alias("size"))
    # components of one block are never cheaper by their buckets
    large = split_join(component, sizes.filter(F.col("size") > block), "component")
    inside = cut(met.join(large, "node"))
    once = ["hub", "last", "m", "x"]
    buckets = inside.filter("node = hub").groupBy("component", "size", *once).agg(F.min("band").alias("band"))
    apart = cut(buckets.groupBy("component", "size").agg(F.sum(cost("m")).alias("cost")).filter(F.col("cost") < cost("size")).select("component"))
    chosen = buckets.join(apart, "component").select("component", *once, "band")
    rows = split_join(inside, chosen, "component", *once, "band").select("node", F.col("bucket").alias("unit"), "band", "m")
    whole = split_join(component, sizes.join(apart, "component", "left_anti"), "component").select("node", F.col("component").alias("unit"), F.lit(-1).alias("band"), F.col("size").alias("m"))
    blocks = F.ceil(F.col("m") / block).cast("int")
    return whole.unionByName(rows).select("node", "unit", "band", blocks.alias("blocks"), F.pmod(F.xxhash64("node"), blocks).cast("int").alias("block"))


def links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, threshold: float = THRESHOLD, recall: float = RECALL, rows: int = ROWS, block: int = BLOCK) -> DataFrame:
    """(doc_id, jid, jhash, copy_of, class_id, n_links, kept) of every row: the smallest ids of its class of equal
    sets and of its group of linked documents, and whether it is the one row of its group that stays."""
    bands, rows = banding(threshold, recall, rows)
    signed = signatures(docs, id_col, text_col, size, bands, rows)
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "jid", "jhash"))
    classes = signed.filter("key is not null").groupBy("key").agg(first.alias("first"), F.count("*").alias("n"), F.any_value("bands").alias("bands"))
    classes = cut(classes.withColumn("node", F.monotonically_increasing_id()))  # read again, the numbers stay
    met = meetings(classes)
    candidates = cut(connected_components(met.filter("node != hub"), "node", "hub"))
    wanted = cut(candidates.join(classes.select("node", "key", "n", "bands", "first.jid", "first.jhash"), "node").drop("component"))
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sets = full_sets(docs, wanted.select("jid", "jhash"), id_col, text_col, size)
    sets = sets.groupBy("key").agg(F.any_value("grams").alias("grams"))  # repeated rows name the same set
    # narrow rows meet first, so that the sets are shuffled once to their units and once to their cells
    placed = units(met, candidates, block).join(wanted.drop("jid", "jhash"), "node").join(sets, "key").drop("key")
    cells = by_cell(placed, verify(threshold), "node long, links long, other long", partitions, ("unit", "band"))
    checked = cut(cells)
    near = connected_components(checked.filter("other is not null"), "node", "other")
    more = checked.groupBy("node").agg(F.sum("links").alias("more"))
    joined = classes.drop("bands").join(near, "node", "left").join(more, "node", "left").withColumn("component", F.coalesce("component", "node"))
    tops = joined.groupBy("component").agg(F.min("first").alias("top"))
    per_class = split_join(joined, tops, "component").select("key", "first", "top", (F.col("n") - 1 + F.coalesce("more", F.lit(0))).alias("n_links"))
    out = signed.drop("bands").join(per_class, "key", "left")
    alone = F.col("key").isNull()
    return out.select(
        "doc_id",
        "jid",
        "jhash",
        F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("copy_of"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("top.doc_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        (alone | (F.col("jid") == F.col("top.jid")) & (F.col("jhash") == F.col("top.jhash"))).alias("kept"),
    )


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of docs of which one stays for each group of near duplicates, with all their columns."""
    found = cut(links(docs, id_col, text_col, **how))
    gone = found.filter("not kept").select("jid", "jhash").distinct()
    again = found.filter("kept and (n_links > 0)").groupBy("jid", "jhash").count().filter("count > 1").select("jid", "jhash")
    names = {x: fresh(docs, f"__{x}") for x in ("jid", "jhash")}
    rows = docs.withColumns({names[x]: c for x, c in zip(names, _address(id_col, text_col), strict=True)})
    gone, again = gone.withColumnsRenamed(names), again.withColumnsRenamed(names)
    on = [*names.values()]
    left = rows.join(gone, on, "left_anti")
    once = left.join(again, on, "left_semi").dropDuplicates(on)
    return left.join(again, on, "left_anti").unionByName(once).select(*[F.col(f"`{x}`") for x in docs.columns])
