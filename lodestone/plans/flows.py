"""The three long flows, each as one lazy plan over landed files. Acquisition itself happens before."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions import numbers as N
from lodestone.functions import text as X
from lodestone.operators import dataset as D
from lodestone.operators import export as E
from lodestone.operators import integrity as I
from lodestone.operators import metrics as M
from lodestone.operators import registry as R
from lodestone.sinks import writers as K
from lodestone.sources import documents as S
from lodestone.sources import files as Fs


@dataclass(frozen=True)
class Batch:
    resolved: DataFrame
    errors: DataFrame
    missing_reverse: DataFrame
    catalog: DataFrame


def translation_batch(spark: SparkSession, request: str, registry: str, catalog: str, version: str, files: str | None = None) -> Batch:
    """Request and registry to resolved entries, their errors (files that are missing or differ, too, if a folder
    of landed gzip files is given), directions without reverse, and the merged catalog."""
    asked = S.batch_request(spark, request).withColumn("request", F.concat_ws(":", "group", "pos"))
    entries = S.registry(spark, registry)
    found = R.resolve(asked, entries.withColumn("score", F.coalesce(F.get(F.map_values(F.get(F.map_values("metrics"), F.lit(0))), F.lit(0)), F.lit(0.0))))
    errors = found.filter("error is not null").select("request", "error")
    entry = lambda p: F.get_json_object("entry", f"$.{p}")
    resolved = asked.drop("architecture", "score").join(found.filter("error is null"), "request").select("group", "pos", "request", "source_language", "target_language", entry("architecture").alias("architecture"), entry("score").cast("double").alias("score"), "entry")
    if files:
        wanted = resolved.select("request", F.explode(F.from_json(entry("files"), "map<string,struct<path:string,uncompressedHash:string>>")).alias("kind", "f"))
        wanted = wanted.select("request", X.stem(F.col("f.path")).alias("name"), F.col("f.uncompressedHash").alias("pin"))
        landed = Fs.inflated(spark, files).select("name", "sha256")
        status = F.when(F.col("sha256").isNull(), "missing").when(F.col("pin").isNotNull() & (F.col("pin") != F.col("sha256")), "hash")
        bad = wanted.join(landed, "name", "left").withColumn("status", status).filter("status is not null")
        errors = errors.unionByName(bad.select("request", F.concat_ws(" ", "status", "name").alias("error")))
    directions = resolved.select(F.col("source_language").alias("source"), F.col("target_language").alias("target"))
    return Batch(resolved, errors, I.missing_reverse(directions), R.catalog_merge(S.catalog(spark, catalog), resolved.drop("entry", "request"), version))


def pack_release(specs: DataFrame, old_manifest: DataFrame, files: DataFrame, family: str, note: str, variants: list[str]) -> tuple[DataFrame, DataFrame]:
    """Manifest and its verification: rows of the specs, described by the files there are, upserted into the old
    manifest (columns of the manifest files, and pos)."""
    rows = E.manifest_rows(E.with_variants(specs, variants), family, note)
    described = rows.join(files.select("name", F.col("size").alias("sizeBytes"), "sha256"), "name", "left").withColumn("pos", F.lit(0))
    manifest = I.upsert(old_manifest.select("name", "sizeBytes", "sha256", "role", "script", "priority", "note", "pos"), described.select("name", "sizeBytes", "sha256", "role", "script", "priority", "note", "pos"))
    return manifest, I.verify_pack(manifest, files)


def dataset_release(samples: DataFrame, path: str, n: int, val_n: int, size: int, order: str = "id") -> DataFrame:
    """Shards of the first n samples and of val_n more for validation, with their lineage, written below path;
    returns the lineage."""
    numbered = D.numbered(samples, order)
    train = D.shards(numbered.filter(F.col("index") < n), n, size)
    val = numbered.filter((F.col("index") >= n) & (F.col("index") < n + val_n)).withColumn("index", F.col("index") - n)
    both = train.unionByName(D.shards(val, val_n, max(val_n, size), "validation", n))
    K.write_shards(both, f"{path}/shards")
    lineage = samples.sparkSession.read.parquet(f"{path}/shards")
    K.write_lineage(lineage, f"{path}/lineage")
    return lineage


def evaluation(predictions: DataFrame, labels: DataFrame) -> DataFrame:
    """(model, metric, value) of predictions (model, strip_id, matte, weight: logits) against labels (strip_id,
    matte, weight), arrays over the pixels of a strip."""
    met = predictions.join(labels.select("strip_id", F.col("matte").alias("m"), F.col("weight").alias("w")), "strip_id")
    from lodestone.functions import arrays as A

    strip = met.select("model", M.matte_iou(F.col("matte"), F.col("m")).alias("iou"), M.masked_mae(F.transform("weight", lambda x: N.sigmoid(x.cast("double"))), F.col("w"), A.above(F.col("m"), 0.5)).alias("mae"))
    one = M.summary(strip, ["model"], "iou").join(M.summary(strip, ["model"], "mae").select("model", F.col("mean").alias("mae")), "model")
    return one.select("model", F.explode(F.map_from_arrays(F.array(F.lit("matte_iou"), F.lit("matte_iou_p5"), F.lit("weight_mae")), F.array("mean", "p5", "mae"))).alias("metric", "value"))
