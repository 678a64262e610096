"""Connected components, and groups taken apart into blocks, for the operators that link rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, split_join


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of the edges; component is the smallest node reachable.

    Alternates large-star and small-star steps (Kiveris et al., 2014), which need about log(n) rounds, until
    the edges are stars around the smallest nodes. Edges are kept once, from the larger end a to the smaller b.
    Every round is one checkpointed job; minima are pre-aggregated, and the join at the smaller ends, of which
    one may have very many edges, is such as Spark can split. Null and equal ends are no edges."""
    ends = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a != b")
    now = cut(ends.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while not _stars(now):
        least = now.groupBy("a").agg(F.min("b").alias("m"))
        # large star: what is above a node goes to that node's smallest neighbour
        large = split_join(now.select(F.col("a").alias("above"), F.col("b").alias("a")), least, "a", how="left").select(F.col("above").alias("a"), F.coalesce("m", "a").alias("b"))
        # small star: a node and all below it go to the smallest of them
        small = large.withColumn("m", F.min("b").over(Window.partitionBy("a")))
        pairs = F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b"))))
        now = cut(small.select(pairs.alias("e")).select("e.*").filter("a != b").distinct())
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select("b", "b").distinct())


def _stars(edges: DataFrame) -> bool:
    """Whether every larger end has one edge and none is a smaller end of another."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("above"), F.lit(0).alias("below")).union(edges.select("b", F.lit(0), F.lit(1)))
    sums = ends.groupBy("node").agg(F.sum("above").alias("above"), F.max("below").alias("below"))
    return sums.filter("above > 1 or above = 1 and below = 1").isEmpty()


def placed(members: DataFrame, block: int, group: str = "component", key: str = "node") -> DataFrame:
    """members with the number of blocks of their group (`blocks`) and their own block in it (`block`)."""
    sizes = members.groupBy(group).agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    return split_join(members, sizes, group).withColumn("block", F.pmod(F.xxhash64(key), F.col("blocks")).cast("int"))


def by_group(rows: DataFrame, keys: list[str], run: Callable[[pa.Table], Iterator[pa.RecordBatch]], schema: str, partitions: int) -> DataFrame:
    """Calls run with the rows of each group in turn. For groups of a bounded size: one is in memory at a time."""
    dealt = rows.repartition(partitions, *keys).sortWithinPartitions(*keys)

    def each(batches):
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            groups = list(zip(*(batch.column(batch.schema.get_field_index(x)).to_pylist() for x in keys), strict=True))
            start = 0
            for k in range(len(groups) + 1):
                if k == len(groups) or groups[k] != last:
                    if k > start:
                        held.append(batch.slice(start, k - start))
                    if k < len(groups):
                        if held:
                            yield from run(pa.Table.from_batches(held))
                        held, start, last = [], k, groups[k]
        if held:
            yield from run(pa.Table.from_batches(held))

    return dealt.mapInArrow(each, schema)


def by_cell(rows: DataFrame, run: Callable[[pa.Table], Iterator[pa.RecordBatch]], schema: str, partitions: int, group: tuple[str, ...] = ("component",)) -> DataFrame:
    """Calls run for every pair of blocks of a group (and each block with itself) with the rows of the two.

    A cell holds the rows of two blocks at most, whatever the size of the group; every row goes to as many cells
    as its group has blocks. No pair of rows is ever emitted: run returns what it counts."""
    both = rows.withColumn("__other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    both = both.withColumn("__i", F.least("block", "__other")).withColumn("__j", F.greatest("block", "__other")).drop("__other", "blocks")
    return by_group(both, [*group, "__i", "__j"], run, schema, partitions)


def forest(n: int, left, right) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links left[k]-right[k] between n places."""
    top = list(range(n))

    def find(x: int) -> int:
        while top[x] != x:
            top[x] = top[top[x]]
            x = top[x]
        return x

    out = []
    for x, y in zip(left, right, strict=True):
        p, q = find(int(x)), find(int(y))
        if p != q:
            top[max(p, q)] = min(p, q)
            out.append((int(x), int(y)))
    return out
