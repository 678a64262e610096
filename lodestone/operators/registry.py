"""Resolving models and merging catalogs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions import numbers as N
from lodestone.functions import text as X
from lodestone.sources.literals import ARCHITECTURES


def rank_of(architecture: Column, preference: list[str] = ARCHITECTURES) -> Column:
    """Place in the order of preference, behind all for others and null."""
    found = F.array_position(F.array(*[F.lit(x) for x in preference]), F.coalesce(architecture, F.lit("")))
    return F.when(found > 0, found).otherwise(F.lit(len(preference) + 1))


def first_by(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key in an order: min of a struct, so rows are reduced before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    places = [c.alias(f"__{k}") for k, c in enumerate(order)]
    best = df.select(*keys, F.struct(*places, *rest).alias("__r")).groupBy(*keys).agg(F.min("__r").alias("__r"))
    return best.select(*keys, *[F.col(f"__r.`{c}`").alias(c) for c in rest])


def preferred(entries: DataFrame, keys: list[str], architecture: str = "architecture", pos: str = "pos", preference: list[str] = ARCHITECTURES) -> DataFrame:
    """The preferred entry of each key: best architecture, then list order."""
    return first_by(entries, keys, rank_of(F.col(architecture), preference), F.col(pos))


def last_wins(rows: DataFrame, keys: list[str], pos: str = "pos") -> DataFrame:
    return first_by(rows, keys, -F.col(pos))


def pair_lookup(requests: DataFrame, entries: DataFrame) -> DataFrame:
    """requests (source_language, target_language) with the entries of their pair, null where there is none."""
    return requests.withColumn("pair", X.pair_key(F.col("source_language"), F.col("target_language"))).join(entries, "pair", "left")


def resolve(requests: DataFrame, entries: DataFrame, id_: str = "request") -> DataFrame:
    """One row per request (id_, source_language, target_language, architecture): the first entry of exactly the
    architecture asked for, or the preferred one where that is null; error tells what there is instead."""
    asked = requests.select(id_, X.pair_key(F.col("source_language"), F.col("target_language")).alias("pair"), F.col("architecture").alias("asked"))
    met = asked.join(entries.select("pair", "pos", F.col("architecture").alias("found"), F.struct(*entries.columns).alias("entry")), "pair", "left")
    fits = F.col("found").isNotNull() & (F.col("asked").isNull() | (F.col("asked") == F.col("found")))
    place = F.when(F.col("asked").isNull(), rank_of(F.col("found"))).otherwise(F.lit(0))
    best = F.min(F.when(fits, F.struct(place.alias("rank"), "pos", F.to_json("entry").alias("entry"))))
    names = F.transform(F.array_sort(F.collect_list(F.when(F.col("found").isNotNull(), F.struct("pos", "found")))), lambda x: x["found"])
    out = met.groupBy(id_, "pair", "asked").agg(best.alias("best"), names.alias("names"))
    error = F.when(F.col("asked").isNull(), F.concat(F.lit("no models for "), F.col("pair"))).otherwise(F.concat(F.lit("no "), F.col("asked"), F.lit(" model for "), F.col("pair"), F.lit("; available: "), X.names_or_none(F.col("names"))))
    return out.select(id_, "pair", F.col("best.entry").alias("entry"), F.when(F.col("best").isNull(), error).alias("error"))


def catalog_merge(catalog: DataFrame, generated: DataFrame, version: str, copied: tuple[str, ...] = ("size", "bundle", "checksum"), matched_only: bool = False) -> DataFrame:
    """catalog with the computed fields of generated: by exact pair, else by the reversed pair of a bidirectional
    entry. A field is copied if the match has it; the score goes to the scale of 100; version is set on every
    entry (with matched_only on matched ones)."""
    key = lambda a, b: F.struct(X.normalize_language(F.col(a)).alias("s"), X.normalize_language(F.col(b)).alias("t"))
    fields = [c for c in (*copied, "score") if c in generated.columns]
    order = [F.col(c) for c in ("group", "pos") if c in generated.columns]
    last = generated.select(key("source_language", "target_language").alias("k"), F.struct(*order).alias("o"), *fields).groupBy("k").agg(F.max_by(F.struct(*fields), "o").alias("m"))
    keyed = catalog.withColumns({"k": key("source_language", "target_language"), "back": key("target_language", "source_language")})
    straight, reverse = last.withColumnRenamed("m", "m1"), last.withColumnsRenamed({"k": "back", "m": "m2"})
    met = keyed.join(straight, "k", "left").join(reverse, "back", "left")
    match = F.when(F.col("m1").isNotNull(), F.col("m1")).when(F.coalesce(F.col("bidirectional"), F.lit(False)), F.col("m2"))
    out = met.withColumn("m", match)
    new = {c: F.coalesce(N.score_100(F.col("m.score")) if c == "score" else F.col(f"m.{c}"), F.col(c)) for c in fields}
    stamp = F.when(F.col("m").isNotNull(), F.lit(version)).otherwise(F.col("version")) if matched_only else F.lit(version)
    return out.withColumns(new | {"version": stamp}).select(*catalog.columns)


def point_update(catalog: DataFrame, id_: str, values: dict[str, Column], pos: str = "pos") -> DataFrame:
    """The first row of an id gets the values; an id that isn't there is an error when the plan runs."""
    first = catalog.filter(F.col("id") == id_).agg(F.coalesce(F.min(pos).cast("long"), F.raise_error(F.lit(f"no entry {id_}")).cast("long")).alias("first"))
    hit = (F.col("id") == id_) & (F.col(pos) == first.scalar())
    return catalog.withColumns({c: F.when(hit, v).otherwise(F.col(c)) for c, v in values.items()})
