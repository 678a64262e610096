"""Near duplicates of embeddings by NN-descent, compared within equal labels only.

Equal vectors of a label become one node first. The neighbour graph starts from random hyperplane buckets, cut
to blocks of bounded size; the mean of a label is taken off its unit vectors before. Then, round by round, each
node brings its neighbours and reverse neighbours together (neighbours of neighbours), and every one of them that
finds a nearer neighbour there takes it into its list. A list that is full of links is saturated and is enlarged,
up to LARGEST. Rounds end when hardly any list changes; then the recall is audited: nodes are compared with all others, and the mean over those that have
links of the share found must reach the target, once among nodes of components of more than NEIGHBOURS nodes
and once among all other nodes. Each of the two samples begins with about AUDITED nodes and grows until ENOUGH
of them have links, or to all. While the recall is below the target further rounds follow, and the next audit
takes other nodes; all links that an audit sees are kept. After 3 times ROUNDS rounds the nodes of a sample that
still misses the target are compared with all others, to the last one: so no state is returned that has not met
the target, but that last way costs a product for each pair of such a node and a node of its label. Edges with
a cosine of the threshold or more, in double precision, are links; a cosine that equals it is one.

Lists are bounded, links are not: in each component of links all pairs are then counted exactly, block against
block inside of tasks, so groups larger than any list keep all their links.

Vectors that are null, empty, zero or hold null or non-finite components, null labels and null ids link with
nothing: no links, their own id as component, kept (unless the id is null). Vectors of different lengths are
never compared. Repeated rows are links of each other. An empty table gives an empty result. Other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, cut, field, split_join
from .components import by_cell, by_group, connected_components, forest, placed

THRESHOLD, NEIGHBOURS, LARGEST, REVERSE, TABLES, BITS, BUCKET, ROUNDS, SETTLED = 0.93, 10, 40, 10, 8, 30, 200, 4, 0.01
BLOCK, AUDITED, ENOUGH, RECALL, SEED = 1024, 256, 128, 0.97, 7
SENT_BYTES, SLICE = 16_000_000, 4096  # of audited vectors sent at once, and compared with a batch at once


def directions(width: int, count: int) -> np.ndarray:
    return np.random.default_rng(SEED + width).standard_normal((width, count))


def nodes(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> tuple[DataFrame, DataFrame]:
    """Rows as (vec_id, key), key null for those that link with nothing; and the nodes (nid, key, label, width,
    n, least, vec), one for each different vector of a label."""

    def run(batches):
        import xxhash

        for batch in batches:
            keys, widths, vecs = [], [], []
            for vec_id, label, vec in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                ok = vec_id is not None and label is not None and vec and None not in vec
                x = np.asarray(vec, np.float64) if ok else np.zeros(0)
                most = np.abs(x).max() if ok else 0.0
                if not ok or not np.isfinite(x).all() or not most:
                    for out in (keys, widths, vecs):
                        out.append(None)
                    continue
                # by a power of two, so exact: squares of very large or small components stay in range
                raw = (np.ldexp(x, -int(np.frexp(most)[1])) + 0.0).tobytes()
                keys.append(xxhash.xxh3_128_digest(raw + str(label).encode()))
                widths.append(len(x))
                vecs.append(raw)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.binary()), batch.column(1), pa.array(widths, pa.int32()), pa.array(vecs, pa.binary())], ["vec_id", "key", "label", "width", "vec"])

    bounded_batches(vectors.sparkSession)
    schema = T.StructType([field(vectors, id_col, "vec_id"), T.StructField("key", T.BinaryType()), T.StructField("label", T.StringType()), T.StructField("width", T.IntegerType()), T.StructField("vec", T.BinaryType())])
    read = cut(vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).alias("vec")).mapInArrow(run, schema))
    groups = read.filter("key is not null").groupBy("key").agg(F.min("vec_id").alias("least"), F.count("*").alias("n"), *[F.any_value(x).alias(x) for x in ("label", "width", "vec")])
    return read.select("vec_id", "key"), cut(groups.withColumn("nid", F.monotonically_increasing_id()))


def unit(vecs: list[bytes]) -> np.ndarray:
    x = np.array([np.frombuffer(v, np.float64) for v in vecs])
    return x / np.sqrt((x * x).sum(1, keepdims=True))


EDGES = "node long, other long, sim double"


def edges_of(nodes_: list[int], others: list[int], sims: list[float]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(nodes_, pa.int64()), pa.array(others, pa.int64()), pa.array(sims, pa.float64())], ["node", "other", "sim"])


SUMS = "label string, width int, size long, total binary"


def sums(points: DataFrame, partitions: int) -> DataFrame:
    """(label, width, size, total): number and sum of the unit vectors of each label."""

    def batch_of(held: dict[tuple, tuple]) -> pa.RecordBatch:
        columns = zip(*((*group, n, total.tobytes()) for group, (n, total) in held.items()), strict=True)
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.string(), pa.int32(), pa.int64(), pa.binary()), strict=True)], ["label", "width", "size", "total"])

    def parts(batches):
        held: dict[tuple, tuple] = {}
        for batch in batches:
            labels, widths, vecs = (x.to_pylist() for x in batch.columns)
            for group, at in places_of(labels, widths).items():
                n, total = held.get(group, (0, np.zeros(group[1])))
                held[group] = n + len(at), total + unit([vecs[k] for k in at]).sum(0)
            if len(held) > 1000:
                yield batch_of(held)
                held = {}
        if held:
            yield batch_of(held)

    def whole(group: pa.Table):
        total = np.array([np.frombuffer(x, np.float64) for x in group["total"].to_pylist()]).sum(0)
        yield batch_of({(group["label"][0].as_py(), group["width"][0].as_py()): (sum(group["size"].to_pylist()), total)})

    return by_group(points.select("label", "width", "vec").mapInArrow(parts, SUMS), ["label", "width"], whole, SUMS, partitions)


def places_of(*columns: list) -> dict[tuple, list[int]]:
    """The places of equal rows of the columns."""
    out: dict[tuple, list[int]] = {}
    for k, row in enumerate(zip(*columns, strict=True)):
        out.setdefault(row, []).append(k)
    return out


def signed(points: DataFrame, partitions: int) -> DataFrame:
    """(nid, label, width, size, signs): hyperplane signs of the vectors without the mean of their label."""

    def run(batches):
        for batch in batches:
            signs: list = [None] * batch.num_rows
            widths, sizes, totals, vecs = (batch.column(k).to_pylist() for k in range(2, 6))
            for (width,), at in places_of(widths).items():
                mean = np.array([np.frombuffer(totals[k], np.float64) / sizes[k] for k in at])
                bits = (unit([vecs[k] for k in at]) - mean) @ directions(width, TABLES * BITS) > 0
                for k, row in zip(at, (bits.reshape(-1, TABLES, BITS) @ (1 << np.arange(BITS))).tolist(), strict=True):
                    signs[k] = row
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(signs, pa.list_(pa.int32()))], ["nid", "label", "width", "size", "signs"])

    rows = split_join(points.select("nid", "label", "width", "vec"), sums(points, partitions), "label", "width")
    return rows.select("nid", "label", "width", "size", "total", "vec").mapInArrow(run, "nid long, label string, width int, size long, signs array<int>")


def start(points: DataFrame, partitions: int, most: int) -> DataFrame:
    """First neighbours: the best of each node in the blocks of its buckets, for every table."""
    bits = F.least(F.lit(BITS), F.greatest(F.lit(0), F.ceil(F.log2(F.col("size") / BUCKET)))).cast("int")
    flat = cut(signed(points, partitions)).select("nid", "label", "width", F.posexplode("signs").alias("t", "sign"), bits.alias("bits"))
    flat = flat.withColumn("bucket", F.pmod(F.col("sign"), F.expr("shiftleft(1, bits)")))
    keys = ["label", "width", "t", "bucket"]
    counts = flat.groupBy(*keys).agg(F.ceil(F.count("*") / (2 * BUCKET)).cast("int").alias("blocks"))
    dealt = split_join(flat, counts, *keys).withColumn("block", F.pmod(F.xxhash64("nid", "t"), F.col("blocks")).cast("int")).select("nid", *keys, "block")

    def run(group: pa.Table):
        if len(group) < 2:
            return
        ids, x = np.array(group["nid"].to_pylist()), unit(group["vec"].to_pylist())
        sims = x @ x.T
        np.fill_diagonal(sims, -2)
        k = min(most, len(ids) - 1)
        best = np.argpartition(-sims, k - 1, axis=1)[:, :k]
        yield edges_of(np.repeat(ids, k), ids[best.ravel()], np.take_along_axis(sims, best, 1).ravel())

    return by_group(dealt.join(points.select("nid", "vec"), "nid"), [*keys, "block"], run, EDGES, partitions)


def nearest(edges: DataFrame, neighbours: int, largest: int, threshold: float) -> DataFrame:
    """The lists: the nearest neighbours of each node, and of a saturated one its links up to largest.
    An edge is new if it was not in the list before."""
    once = edges.groupBy("node", "other").agg(F.max("sim").alias("sim"), F.min("new").alias("new"))
    rank = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("sim"), "other"))
    return once.withColumn("rank", rank).filter((F.col("rank") <= neighbours) | (F.col("sim") >= threshold) & (F.col("rank") <= largest)).drop("rank")


def step(graph: DataFrame, points: DataFrame, partitions: int, neighbours: int, largest: int, reverse: int, threshold: float) -> DataFrame:
    """One round: edges that are nearer than what a list holds so far, found among neighbours of neighbours."""
    # every node has `largest` rows at most; of reverse neighbours a node brings the nearest, the others bring it
    rank = F.row_number().over(Window.partitionBy("other").orderBy(F.desc("sim"), "node"))
    back = graph.withColumn("rank", rank).filter(F.col("rank") <= reverse).select(F.col("other").alias("node"), F.col("node").alias("other"), "new")
    near = graph.withColumn("r", F.row_number().over(Window.partitionBy("node").orderBy(F.desc("new"), F.desc("sim"), "other"))).filter(F.col("r") <= neighbours).select("node", "other", "new")
    met = near.union(back).repartition(partitions, "node").groupBy("node", "other").agg(F.max("new").alias("new"))
    # a node among whose neighbours nothing is new finds nothing: its vectors aren't fetched
    met = met.withColumn("any", F.max("new").over(Window.partitionBy("node"))).filter("any").drop("any")
    full = F.when(F.count("*") < neighbours, -2.0).when((F.count_if(F.col("sim") >= threshold) >= neighbours) & (F.count("*") < largest), F.lit(threshold)).otherwise(F.min("sim"))
    ends = graph.groupBy("node").agg(full.alias("least")).withColumnRenamed("node", "nid")
    known = points.select("nid", "vec").join(ends, "nid")
    rows = met.join(known.withColumnRenamed("nid", "other"), "other")

    def run(group: pa.Table):
        new = np.array(group["new"].to_pylist(), bool)
        if len(new) < 2 or not new.any():
            return
        ids, least, x = np.array(group["other"].to_pylist()), np.array(group["least"].to_pylist()), unit(group["vec"].to_pylist())
        sims = x @ x.T
        a, b = np.nonzero((new[:, None] | new[None, :]) & (sims > least[:, None] + 1e-12) & ~np.eye(len(ids), dtype=bool))
        if len(a):
            yield edges_of(ids[a], ids[b], sims[a, b])

    return by_group(rows, ["node"], run, EDGES, partitions)


def members(points: DataFrame, component: DataFrame, most: int, order: int = 0, seen: DataFrame | None = None) -> DataFrame:
    """The nodes with their component (themselves where there is none), whether it is large, that is of more than
    `most` nodes, whether they were compared with all before (seen: nid, seen), and their place between 0 and 1 in
    the order of this audit."""
    sizes = component.groupBy("component").agg(F.count("*").alias("size"))
    known = split_join(component, sizes, "component").select(F.col("node").alias("nid"), "component", (F.col("size") > most).alias("large"))
    rows = points.join(known, "nid", "left")
    rows = rows.withColumn("seen", F.lit(False)) if seen is None else rows.join(seen, "nid")
    place = F.xxhash64("key", F.lit(order)) / float(2**64) + 0.5
    return cut(rows.select("seen", "nid", "label", "width", "vec", F.coalesce("component", "nid").alias("component"), F.coalesce("large", F.lit(False)).alias("large"), place.alias("place")))


COMPARED = "node long, other long, links long, held long"


def missing_of(nodes_: np.ndarray, others: np.ndarray) -> pa.RecordBatch:
    none = pa.nulls(len(nodes_), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(nodes_, pa.int64()), pa.array(others, pa.int64()), none, none], COMPARED.replace(" long", "").split(", "))


def compared(nodes_: DataFrame, sample: list[Row], threshold: float) -> DataFrame:
    """By brute force of the sampled nodes over all: (node, links, held), the number of true links of each, and how
    many of them lie in its component; and (node, other), links that tie the components of the others together."""
    by = places_of([r.label for r in sample], [r.width for r in sample])
    column = lambda at, name: np.array([sample[k][name] for k in at])
    sent = nodes_.sparkSession.sparkContext.broadcast({group: (column(at, "nid"), column(at, "component"), unit([bytes(sample[k].vec) for k in at])) for group, at in by.items()})  # SENT_BYTES of vectors

    def run(batches):
        counts = {group: np.zeros((2, len(names)), np.int64) for group, (names, _, _) in sent.value.items()}
        for batch in batches:
            ids, labels, widths, vecs, tops = (x.to_pylist() for x in batch.columns)
            for group, at in places_of(labels, widths).items():
                if group not in counts:
                    continue
                names, parts, x = sent.value[group]
                mine, top, y = np.array(ids)[at], np.array(tops)[at], unit([vecs[k] for k in at])
                for k in range(0, len(names), SLICE):
                    a, b = np.nonzero(y @ x[k : k + SLICE].T >= threshold)
                    b += k
                    apart = mine[a] != names[b]
                    a, b = a[apart], b[apart]
                    same = top[a] == parts[b]
                    if not same.all():
                        ends, at_ends = np.unique([top[a[~same]], parts[b[~same]]], return_inverse=True)
                        pairs = np.unique(at_ends.reshape(2, -1), axis=1)
                        tied = np.array(forest(len(ends), *pairs))
                        yield missing_of(ends[tied[:, 0]], ends[tied[:, 1]])
                    counts[group] += [np.bincount(b, minlength=len(names)), np.bincount(b[same], minlength=len(names))]
        for group, (links_, held) in counts.items():
            some = links_ > 0
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (sent.value[group][0][some], [None] * int(some.sum()), links_[some], held[some])], COMPARED.replace(" long", "").split(", "))

    return cut(nodes_.select("nid", "label", "width", "vec", "component").mapInArrow(run, COMPARED))


def audit(nodes_: DataFrame, large: bool, threshold: float, low: float = 0.0, whole: bool = False, audited: int = AUDITED, enough: int = ENOUGH) -> tuple[float, float, list[DataFrame]]:
    """Mean over the nodes with links of the share of these that their components hold, from nodes of large
    components or from the others, not seen before, at places from low on. The sample grows until `enough` of its
    nodes have links, or to all nodes, as it does if whole. Also the place where it ends, and the missing links
    found, as pairs of components."""
    those = nodes_.filter((F.col("large") == large) & ~F.col("seen"))
    size, width = those.agg(F.count("*"), F.max("width")).first()
    if not size:
        return 1.0, 1.0, []
    most = max(1, SENT_BYTES // (8 * width))
    linked, total, missing = 0, 0.0, []
    while low < 1 and (whole or linked < enough):
        step_ = min(most if whole else audited, most)
        high = 1.0 if (1 - low) * size <= step_ else low + step_ / size
        sample = those.filter((F.col("place") >= low) & ((F.col("place") < high) | F.lit(high == 1))).collect()
        found = compared(nodes_, sample, threshold)
        by_node = found.groupBy("node").agg((F.sum("held") / F.sum("links")).alias("share"), F.count("other").alias("apart"))
        n, shares, apart = by_node.agg(F.count("share"), F.sum("share"), F.sum("apart")).first()
        if apart:
            missing.append(found.filter("other is not null").select("node", "other").distinct())
        low, linked, total, audited = high, linked + n, total + (shares or 0.0), 4 * audited
    return total / linked if linked else 1.0, low, missing


def count_links(threshold: float):
    """For by_cell: (node, links), how many vectors each node of the cell links to."""

    def run(cell: pa.Table):
        i, j = cell["__i"][0].as_py(), cell["__j"][0].as_py()
        ids, block, n = np.array(cell["node"].to_pylist()), np.array(cell["block"].to_pylist()), np.array(cell["n"].to_pylist())
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        if not len(left) or not len(right):
            return
        x = unit(cell["vec"].to_pylist())
        linked = x[left] @ x[right].T >= threshold
        if i == j:
            np.fill_diagonal(linked, False)
        links = np.zeros(len(ids), np.int64)
        links[left] += linked @ n[right]
        if i != j:
            links[right] += n[left] @ linked
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(links, pa.int64())], ["node", "links"])

    return run


def joined(pairs: DataFrame, more: list[DataFrame]) -> DataFrame:
    """(node, component) of the pairs, whatever their names, together with more."""
    for x in more:
        pairs = pairs.union(x)
    return cut(connected_components(pairs, *pairs.columns))


def links(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = THRESHOLD, neighbours: int = NEIGHBOURS, largest: int = LARGEST, reverse: int = REVERSE, rounds: int = ROUNDS, recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    partitions = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows, points = nodes(vectors, id_col, vector_col, label_col)
    first = start(points, partitions, max(2, neighbours // 2)).withColumn("new", F.lit(True))
    graph = cut(nearest(first, neighbours, largest, threshold))
    size, done, small = points.count(), 0, neighbours
    component, seen = None, None
    while True:
        for _ in range(rounds):
            found = step(graph, points, partitions, neighbours, largest, reverse, threshold).withColumn("new", F.lit(True))
            graph = cut(nearest(graph.withColumn("new", F.lit(False)).unionByName(found), neighbours, largest, threshold))
            done += 1
            if graph.filter("new").count() < SETTLED * size * neighbours:
                break
        near = graph.filter(F.col("sim") >= threshold).select("node", "other")
        # what an audit has seen stays linked
        component = joined(near, [] if component is None else [component])
        checked, met, missing, ends = members(points, component, small, done, seen), True, [], {}
        for large in (False, True):
            share, ends[large], more = audit(checked, large, threshold)
            missing += more
            if share < recall and ends[large] < 1 and done >= 3 * rounds:
                _, ends[large], more = audit(checked, large, threshold, ends[large], whole=True)
                missing += more
            met &= share >= recall or ends[large] == 1
        seen = checked.select("nid", (F.col("seen") | (F.col("place") < F.when(F.col("large"), ends[True]).otherwise(ends[False]))).alias("seen"))
        if missing:
            component = joined(component, missing)
        if met:
            break
        neighbours, largest, reverse = 2 * neighbours, 2 * largest, 2 * reverse
        graph = graph.withColumn("new", F.lit(True))
    group = placed(component, block).join(points.select(F.col("nid").alias("node"), "n", "vec", "least"), "node")
    more = by_cell(group, count_links(threshold), "node long, links long", partitions).groupBy("node").agg(F.sum("links").alias("more"))
    tops = group.groupBy("component").agg(F.min("least").alias("top"))
    linked = split_join(group.select("node", "component"), tops, "component").join(more, "node").select(F.col("node").alias("nid"), "top", "more")
    known = points.select("nid", "key", "n", "least").join(linked, "nid", "left")
    out = rows.join(known, "key", "left")
    component_id = F.coalesce("top", "least", "vec_id")
    return out.select("vec_id", F.coalesce(F.col("n") - 1 + F.coalesce("more", F.lit(0)), F.lit(0)).alias("n_links"), component_id.alias("component_id"), (F.col("vec_id") == component_id).alias("kept"))
