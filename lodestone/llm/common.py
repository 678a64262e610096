"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestone.session import cut, scratch, shared_dir  # noqa: F401

#: Rows and bytes of one Arrow batch handed to a Python worker.
BATCH_ROWS, BATCH_BYTES = "500", "8m"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once for each application."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    with zipfile.ZipFile(to := Path(tempfile.mkdtemp(prefix="lodestone-")) / "lodestone_package.zip", "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(str(to))
    _shipped.add(sc.applicationId)


def bounded_batches(spark: SparkSession) -> None:
    """Bounds Arrow batches by rows and bytes, so that long texts don't add up in a worker.

    Plans read these settings when they run, so they stay in the session; a caller's own number of rows is kept."""
    ship(spark)
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def held_out(doc_id: str | Column, folds: int = 5) -> Column:
    """True where crc32 of the id as text leaves no remainder; null ids are held out, too."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(col.cast("string").cast("binary")) % folds == 0, F.lit(True))


def split_join(rows: DataFrame, sums: DataFrame, *keys: str, how: str = "inner") -> DataFrame:
    """rows with the columns of sums, an aggregate by the keys, which are never null.

    Spark can split the rows of a hot key only if both sides are dealt out for the join itself. An aggregate by
    the same keys is dealt out already; wrapping the keys in a struct has it dealt out anew, one row per key."""
    rest = [c for c in sums.columns if c not in keys]
    return rows.withColumn("__keys", F.struct(*keys)).join(sums.select(F.struct(*keys).alias("__keys"), *rest), "__keys", how).drop("__keys")


#: Bits of a filter at most: what is broadcast stays below 2**20 rows of 16 bytes, however many keys there are.
MOST_BITS = 1 << 26


def maybe_in(rows: DataFrame, key: Column, keys: DataFrame, name: str, most_bits: int = MOST_BITS) -> DataFrame:
    """rows with the boolean column name, false where key, hashed, is surely not in the one column of keys.

    A bit set of bounded size stands for the keys, as a small table that every task gets: rows that have no
    partner needn't be shuffled for a join. Some rows without a partner are let through, none with one is lost.
    keys is read twice, so it should be computed already."""
    bits = min(most_bits, 1 << max(10, (16 * keys.count()).bit_length()))
    (column,) = keys.columns
    place = lambda x: F.pmod(F.xxhash64(x), F.lit(bits))
    word, bit = fresh(rows, f"__{name}_w"), fresh(rows, f"__{name}_b")
    p = place(F.col(column))
    held = keys.select(F.shiftright(p, 6).alias(word), F.lit(1).cast("long").alias("one"), F.pmod(p, F.lit(64)).cast("int").alias("k"))
    held = held.groupBy(word).agg(F.bit_or(F.expr("shiftleft(one, k)")).alias(bit))
    mine = place(key)
    there = F.coalesce(F.expr(f"shiftright(`{bit}`, `{bit}_k`) & 1") == 1, F.lit(False))
    return rows.withColumns({word: F.shiftright(mine, 6), f"{bit}_k": F.pmod(mine, F.lit(64)).cast("int")}).join(F.broadcast(held), word, "left").withColumn(name, there).drop(word, bit, f"{bit}_k")


def field(df: DataFrame, name: str, renamed: str | None = None) -> T.StructField:
    return T.StructField(renamed or name, df.schema[name].dataType, True)


def fresh(df: DataFrame, name: str) -> str:
    """name, or a longer one that no column of df has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text), null texts as empty ones, whatever other columns there are."""
    bounded_batches(df.sparkSession)
    return df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def spread(text: Column, most: int, parts: int = 4) -> Column:
    """text, or evenly spaced parts of it of most characters together: bounds what a sampled row may hold."""
    size = most // parts
    step = (F.length(text) - size) / (parts - 1)
    return F.when(F.length(text) <= most, text).otherwise(F.concat_ws("\n", *[F.substring(text, (F.lit(k) * step + 1).cast("int"), F.lit(size)) for k in range(parts)]))


def sampled(rows: DataFrame, key: str | Column, class_col: str, per_class: int) -> DataFrame:
    """About per_class rows of each class: those whose hash of key is lowest; all rows of smaller classes.

    The bound on the hash comes from a count by class, so no class is gathered in one task; of the counts only
    those of classes over per_class reach the driver."""
    large = rows.groupBy(class_col).count().filter(F.col("count") > per_class).collect()
    if not large:
        return rows
    shares = F.create_map(*[x for value, n in large for x in (F.lit(value), F.lit(per_class / n))])
    place = F.xxhash64(key) / float(2**64) + 0.5
    return rows.filter(place < F.coalesce(shares[F.col(class_col)], F.lit(1.0)))
