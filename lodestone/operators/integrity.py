"""Packs, manifests, pins and language pairs. Violations are rows; strict() turns them into an error."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def verify_pack(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """(name, status) of each manifest entry: missing, size, hash or ok, tested in this order. Other files are
    ignored. manifest: name, sizeBytes, sha256; files: name, size, sha256."""
    f = files.select("name", F.col("size").alias("__size"), F.col("sha256").alias("__hash"), F.lit(True).alias("__there"))
    status = F.when(F.col("__there").isNull(), "missing").when(~F.col("sizeBytes").eqNullSafe(F.col("__size")), "size").when(~F.col("sha256").eqNullSafe(F.col("__hash")), "hash").otherwise("ok")
    return manifest.join(f, "name", "left").select("name", status.alias("status"))


def strict(violations: DataFrame, message: Column) -> DataFrame:
    """Fails with the message of the first violation that a task meets."""
    return violations.select(F.raise_error(message).alias("error"))


def upsert(old: DataFrame, new: DataFrame, key: str = "name", pos: str = "pos") -> DataFrame:
    """old without what new replaces, then new, whose last row of a key wins; replaced entries move to the end."""
    rest = [c for c in new.columns if c != key]
    last = new.groupBy(key).agg(F.max_by(F.struct(*rest), pos).alias("r")).select(key, "r.*").select(*new.columns)
    kept = old.join(last.select(key), key, "left_anti").withColumn("__part", F.lit(0))
    return kept.unionByName(last.withColumn("__part", F.lit(1))).withColumnRenamed("__part", "part")


def compare_pins(assets: DataFrame, pins: DataFrame, key: str = "dest") -> DataFrame:
    """assets (key, sha256) with whether their pin agrees; without a pin anything does."""
    p = pins.select(key, F.col("sha256").alias("pin"))
    ok = F.col("pin").isNull() | F.coalesce(F.col("pin") == F.col("sha256"), F.lit(False))
    return assets.join(p, key, "left").select(key, "sha256", "pin", ok.alias("ok"))


def absent(wanted: DataFrame, present: DataFrame, *keys: str) -> DataFrame:
    """Rows of wanted whose keys present doesn't hold; null keys equal each other."""
    p = present.select(*[F.col(k).alias(f"__{k}") for k in keys]).distinct()
    return wanted.join(p, reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]), "left_anti")


def members(rows: DataFrame, allowed: DataFrame, key: str) -> DataFrame:
    return rows.join(allowed.select(key).distinct(), key, "left_semi")


def missing_fields(*names: str) -> Column:
    """The names of the columns that are null; 0 and "" count as there."""
    return F.filter(F.array(*[F.when(F.col(f"`{n}`").isNull(), F.lit(n)) for n in names]), lambda x: x.isNotNull())


def required(rows: DataFrame, *names: str) -> DataFrame:
    """Rows with missing fields, and which (column missing, comma-joined)."""
    m = missing_fields(*names)
    return rows.withColumn("missing", F.array_join(m, ", ")).filter(F.size(m) > 0)


def missing_reverse(pairs: DataFrame, source: str = "source", target: str = "target") -> DataFrame:
    """The reverse of each direction that has none, once for each row that lacks it."""
    back = pairs.select(F.col(target).alias("__s"), F.col(source).alias("__t")).distinct()
    lone = pairs.join(back, (F.col(source) == F.col("__s")) & (F.col(target) == F.col("__t")), "left_anti")
    return lone.select(F.col(target).alias(source), F.col(source).alias(target))


def languages(pairs: DataFrame, source: str = "source", target: str = "target") -> DataFrame:
    """One row: the languages of all pairs, sorted, and their number. Distinct is partial before the shuffle; the
    list is one value by its nature, so the distinct languages must fit a task."""
    both = pairs.select(F.explode(F.array(source, target)).alias("l")).distinct()
    return both.agg(F.array_sort(F.collect_list("l")).alias("languages"), F.count("*").alias("n"))


def language_set(variant: Column, full: list[str]) -> Column:
    """English alone for variants that end in .en, else the full list."""
    return F.when(F.endswith(variant, F.lit(".en")), F.array(F.lit("en"))).otherwise(F.array(*[F.lit(x) for x in full]))


def source_of(hub: Column, url: Column) -> Column:
    return F.coalesce(hub, url, F.raise_error(F.lit("neither hub nor url")).cast("string"))


def pair_report(pairs: DataFrame) -> DataFrame:
    """One row: the missing directions as text, null where none are."""
    names = F.array_sort(F.collect_list(F.concat_ws("-", "source", "target")))
    return missing_reverse(pairs).agg(F.nullif(F.array_join(names, ", "), F.lit("")).alias("missing"))
