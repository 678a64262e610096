"""Materializing datasets: filters, choices, shards, batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions import numbers as N
from lodestone.functions import text as X
from lodestone.session import cut


def keep_token(word: Column) -> Column:
    """2 to 12 characters, and letters only or all lower case."""
    w = X.strip(word)
    # most words are plain letters, which one pattern tells
    return word.rlike(r"^\p{L}{2,12}$") | F.length(w).between(2, 12) & (w.rlike(r"^\p{L}+$") | (w == F.lower(w)))


def keep_script(line: Column, blocks: list[tuple[int, int]]) -> Column:
    """The token ahead of the first space has 2 to 12 characters, all of them in the blocks."""
    token = X.strip(F.substring_index(line, " ", 1))
    return F.length(token).between(2, 12) & X.in_blocks(token, blocks)


def first_n(rows: DataFrame, order: str, n: int) -> DataFrame:
    """The first n rows in an explicit order: each task keeps its n, the rest meets in one."""
    return rows.orderBy(order).limit(n)


def _dealt(rows: DataFrame, *order: str) -> DataFrame:
    """rows range-partitioned and sorted, with their partition (__p) and their place in it (__n), computed once.

    A range partitioning samples its input, so two passes over it may differ: what is counted and what is numbered
    must be the same written rows. Ties go by a hash of the whole row, which also spreads an order key that very
    many rows share."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # a fixed number, which is never coalesced
    hashed = [F.col(f"`{c}`") for c, kind in rows.dtypes if "map<" not in kind and "variant" not in kind]
    by = [*order, "__tie"]
    dealt = rows.withColumn("__tie", F.xxhash64(*hashed)).repartitionByRange(n, *by).sortWithinPartitions(*by)
    dealt = dealt.withColumn("__p", F.spark_partition_id()).withColumn("__n", F.monotonically_increasing_id() - F.shiftleft(F.col("__p").cast("long"), 33))
    return cut(dealt.drop("__tie"))


def numbered(rows: DataFrame, *order: str) -> DataFrame:
    """rows with their place (index, from 0) in a total order, without gathering them in one task.

    Rows are range-partitioned once, and written once to the shared folder; a count per partition, small, gives
    every partition its offset."""
    local = _dealt(rows, *order)
    counts = local.groupBy("__p").agg(F.count("*").alias("__c"))
    before = F.sum("__c").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("__p", F.coalesce(before, F.lit(0)).alias("__o"))  # one row per partition
    return local.join(F.broadcast(offsets), "__p").withColumn("index", F.col("__o") + F.col("__n")).drop("__p", "__n", "__o")


#: Rows that a single task may order.
FEW = 200_000


def running(rows: DataFrame, by: list[str], order: list[str], value: Column, name: str, few: int = FEW) -> DataFrame:
    """rows with the sum of value over those before them in their group, in an order.

    Groups may be of any size: rows are dealt out by ranges of group and order, and every range is summed up by
    itself. A table of few rows is left to plain windows."""
    v = rows.withColumn("__v", value)
    before = lambda c, *keys: F.coalesce(F.sum(c).over(Window.partitionBy(*keys[0]).orderBy(*keys[1]).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    if v.limit(few + 1).count() <= few:
        return v.withColumn(name, before("__v", by, order)).drop("__v")
    local = _dealt(v, *by, *order)
    local = local.withColumn("__in", before("__v", ["__p", *by], ["__n"])).withColumn("__g", F.struct("__p", *by))
    sums = local.groupBy("__p", *by).agg(F.sum("__v").alias("__s"))
    offsets = sums.select(F.struct("__p", *by).alias("__g"), before("__s", by, ["__p"]).alias("__o"))
    return local.join(offsets, "__g").withColumn(name, F.col("__in") + F.col("__o")).drop("__v", "__p", "__n", "__in", "__g", "__o")


def shards(rows: DataFrame, total: int, size: int, split: str = "train", offset: int = 0, index: str = "index") -> DataFrame:
    """Shard, row in it, shard name and global index of rows numbered from 0."""
    n = max(1, -(-total // size))
    shard = F.floor(F.col(index) / size).cast("int")
    return rows.withColumns({"shard_no": shard, "row": (F.col(index) % size).cast("int"), "shard": X.shard_name(F.lit(split), shard, F.lit(n)), index: F.col(index) + offset})


def inverse_cdf(rows: DataFrame, weights: DataFrame, r: str = "r", value: str = "script") -> DataFrame:
    """The first value, in declared order, whose cumulative share exceeds r. weights (ord, value, weight) is a
    literal table of few rows."""
    total = F.sum("weight").over(Window.partitionBy())
    acc = F.sum("weight").over(Window.orderBy("ord")) / total
    steps = weights.select("ord", F.col(value).alias("__v"), acc.alias("__acc"))
    ladder = steps.agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "__acc", "__v"))), lambda x: F.struct(x["__acc"].alias("acc"), x["__v"].alias("v"))).alias("__l"))
    found = F.filter("__l", lambda x: x["acc"] > F.col(r))
    return rows.withColumn("__l", ladder.scalar()).withColumn(value, F.get(found, F.lit(0))["v"]).drop("__l")


def shuffle_key(key: str, seed: int) -> Column:
    return F.sha2(F.concat_ws(":", F.col(key).cast("string"), F.lit(seed)).cast("binary"), 256)


def shuffled(rows: DataFrame, key: str, seed: int) -> DataFrame:
    """Sorted by a hash of key and seed: the same order in any engine."""
    return rows.orderBy(shuffle_key(key, seed), key)


def workers(shards_: DataFrame, n: int, index: str = "index") -> DataFrame:
    """(worker, shard...) by index modulo n; a worker without a shard reads them all."""
    have = shards_.withColumn("worker", (F.col(index) % n).cast("int"))
    spark = shards_.sparkSession
    idle = spark.range(n).select(F.col("id").cast("int").alias("worker")).join(have.select("worker").distinct(), "worker", "left_anti")
    pairs = shards_.withColumn("worker", F.explode(F.array(*[F.lit(k) for k in range(n)]))).join(idle, "worker", "left_semi")
    return have.unionByName(pairs)


def batches(rows: DataFrame, width: str, order: str, size: int) -> DataFrame:
    """Batch number of each row within its width; rows of the last, incomplete batch are left out."""
    placed = running(rows, [width], [order], F.lit(1), "__at")
    sizes = rows.groupBy(F.struct(width).alias("__w")).agg(F.count("*").alias("__n"))
    out = placed.withColumn("batch", F.floor(F.col("__at") / size).cast("int")).withColumn("__w", F.struct(width)).join(sizes, "__w")
    return out.filter((F.col("batch") + 1) * size <= F.col("__n")).drop("__n", "__w", "__at")


def replayed(rows: DataFrame, reuse: int) -> DataFrame:
    return rows.withColumn("replay", F.explode(F.sequence(F.lit(1), F.lit(reuse))))


def periodic(step: Column, every: int) -> Column:
    return step % every == 0


def sample_parameters(ids: DataFrame, weights: DataFrame, id_: str = "id", fonts: int = 40) -> DataFrame:
    """Script, font (of `fonts` by number), height, stroke, width, ink and paper of a sample, each from uniforms of its
    id: the same in any order. Ink is dark, now and then light; paper is any color, half of the time a bright one."""
    u = lambda salt: N.uniform(F.col(id_), salt)
    out = inverse_cdf(ids.withColumn("r", u("script")), weights).drop("r")
    color = lambda name: F.array(*[u(f"{name} {c}") for c in "rgb"])
    ink = F.transform(color("ink"), lambda x: F.when(u("light") < 0.08, x * 0.5 + 0.5).otherwise(x * 0.45))
    paper = F.transform(color("paper"), lambda x: F.when(u("bright") < 0.5, F.lit(0.6) + 0.4 * x).otherwise(x))
    stroke = F.when(u("stroke") < 0.86, 0).when(u("stroke") < 0.96, 1).otherwise(2)
    return out.withColumns({"native_h": (F.lit(12) + F.floor(u("height") * 33)).cast("int"), "stroke_w": stroke, "width": (F.lit(96) + 16 * F.floor(u("width") * 27)).cast("int"), "font": F.floor(u("font") * fonts).cast("int"), "ink": ink, "paper": paper})
