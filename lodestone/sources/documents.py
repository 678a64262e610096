"""JSON documents: registries, requests, catalogs, bundle metadata, manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone import schemas
from lodestone.functions import text as X


def _whole(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.text(list(paths), wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")


def registry(spark: SparkSession, path: str) -> DataFrame:
    """(base_url, pair, pos, entry...) of a registry document, one row per entry in list order."""
    doc = _whole(spark, path).select(F.from_json("value", schemas.REGISTRY).alias("d"))
    pairs = doc.select(F.col("d.baseUrl").alias("base_url"), F.explode("d.models").alias("pair", "entries"))
    return pairs.select("base_url", "pair", F.posexplode("entries").alias("pos", "entry")).select("base_url", "pair", "pos", "entry.*")


def registry_files(entries: DataFrame) -> DataFrame:
    """One row for each file of each registry entry."""
    keys = [c for c in entries.columns if c != "files"]
    return entries.select(*keys, F.explode("files").alias("kind", "file")).select(*keys, "kind", "file.path", F.col("file.uncompressedHash").alias("hash"))


def with_model_config(entries: DataFrame, configs: DataFrame) -> DataFrame:
    """entries with the config found at the folder of their model file (column url), null where there is none."""
    model = F.col("files").getItem("model")["path"]
    return entries.withColumn("url", X.url_parent(X.url_join(F.col("base_url"), model))).join(configs, "url", "left")


def model_configs(spark: SparkSession, path: str) -> DataFrame:
    """(url, config...) of landed metadata documents; unreadable ones give null fields."""
    doc = _whole(spark, path).select(X.url_parent(F.col("file")).alias("url"), F.from_json("value", schemas.MODEL_CONFIG).alias("d"))
    c = lambda x: F.col(f"d.modelConfig.`{x}`")
    return doc.select("url", c("enc-depth").alias("encoder_depth"), c("dec-depth").alias("decoder_depth"), c("transformer-ffn-depth").alias("ffn_depth"), c("transformer-heads").alias("heads"), X.version(c("version")).alias("version"))


def _grouped(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    doc = _whole(spark, path).select(F.from_json("value", ddl).alias("g")).select(F.posexplode("g").alias("group", "rows"))
    return doc.select("group", F.posexplode("rows").alias("pos", "r")).select("group", "pos", "r.*")


def batch_request(spark: SparkSession, path: str) -> DataFrame:
    """(group, pos, source_language, target_language, architecture, score) of a list of lists; "" is null."""
    return _grouped(spark, path, schemas.BATCH_REQUEST).withColumn("architecture", F.nullif("architecture", F.lit("")))


def catalog(spark: SparkSession, path: str) -> DataFrame:
    return _grouped(spark, path, schemas.CATALOG)


def generated(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a generated catalog, which is {version, models: [[..]]} or the bare list of lists."""
    doc = _whole(spark, path)
    bare = F.from_json("value", schemas.GENERATED_MODELS)
    groups = F.when(F.ltrim("value").startswith("["), bare).otherwise(F.from_json("value", schemas.GENERATED)["models"])
    return doc.select(F.posexplode(groups).alias("group", "rows")).select("group", F.posexplode("rows").alias("pos", "r")).select("group", "pos", "r.*")


def bundle_metadata(spark: SparkSession, *paths: str) -> DataFrame:
    """Metadata of one or many bundle folders; directory falls back to the folder of the file."""
    df = spark.read.schema(schemas.BUNDLE_METADATA).json(list(paths), multiLine=True)
    return df.withColumn("directory", F.coalesce(F.nullif("directory", F.lit("")), X.url_parent(F.col("_metadata.file_path"))))


def flat_catalog(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.FLAT_CATALOG).json(path, multiLine=True)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """(version, pack, pos, name, sizeBytes, sha256, role, script, priority, note)."""
    df = spark.read.schema(schemas.MANIFEST).json(path, multiLine=True)
    return df.select("version", "pack", F.posexplode("files").alias("pos", "f")).select("version", "pack", "pos", "f.*")


def phonemes(spark: SparkSession, path: str) -> DataFrame:
    """(phoneme, id): the first id of each phoneme."""
    df = _whole(spark, path).select(F.from_json("value", schemas.PHONEME_MAP)["phoneme_id_map"].alias("m"))
    return df.select(F.explode(F.transform_values("m", lambda _, v: F.get(v, F.lit(0)))).alias("phoneme", "id"))


def yaml_list(spark: SparkSession, path: str, key: str) -> DataFrame:
    """(pos, value) of the block list below key in a flat YAML file: lines `- value`, quoted or not."""
    lines = F.split(F.col("value"), "\n")
    start = F.array_position(F.transform(lines, lambda x: X.strip(x)), f"{key}:")
    after = F.filter(F.slice(lines, start.cast("int") + 1, F.size(lines)), lambda x: x.rlike(r"^\s*- "))
    item = F.regexp_replace(F.regexp_replace(F.col("item"), r"^\s*- ", ""), r"""^(['"])(.*)\1$""", "$2")
    return _whole(spark, path).filter(start > 0).select(F.posexplode(after).alias("pos", "item")).select("pos", item.alias("value"))


def json_number(column: Column, path: str, default: float = 0.0) -> Column:
    """A number at a JSON path, or default."""
    return F.coalesce(F.get_json_object(column, path).cast("double"), F.lit(default))


def json_or_empty(column: Column) -> Column:
    """The document, or {} where it can't be had."""
    return F.coalesce(F.when(F.try_parse_json(column).isNotNull(), column), F.lit("{}"))
