"""Small fixed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodestone import schemas

#: Architectures, best first.
ARCHITECTURES = ["tiny", "base-memory", "base"]

#: Code-point ranges of the scripts of word lists.
BLOCKS = {
    "ar": [(0x0600, 0x06FF)],
    "hi": [(0x0900, 0x097F)],
    "ta": [(0x0B80, 0x0BFF)],
    "th": [(0x0E00, 0x0E7F)],
    "zh_cn": [(0x4E00, 0x9FFF)],
    "ja": [(0x4E00, 0x9FFF), (0x3040, 0x30FF)],
    "ko": [(0xAC00, 0xD7A3), (0x4E00, 0x9FFF)],
}

#: The word lists of each script.
WORD_LISTS = {"arabic": ["ar"], "devanagari": ["hi"], "tamil": ["ta"], "thai": ["th"], "cjk": ["zh_cn", "ja", "ko"]}

#: Weights of the scripts, in the order that the choice goes through them.
SCRIPT_WEIGHTS = {"latin": 50, "cjk": 20, "arabic": 10, "devanagari": 8, "tamil": 6, "thai": 6}

#: Nodes folded in each detector variant, and the priority of each variant.
FOLDS = {"half": ["ConvTranspose.2"], "quarter": ["ConvTranspose.2", "ConvTranspose.0"]}
PRIORITIES = {"": 2, "half": 1, "quarter": 3}

#: Kinds of models that are named after their stem.
STEM_KINDS = ("aligner", "glyphmatte")

#: Columns of a shard.
SHARD_COLUMNS = ["rgb", "matte", "weight", "foreground", "background"]


def architectures(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(x, k) for k, x in enumerate(ARCHITECTURES)], "architecture string, rank int")


def script_weights(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(k, s, w) for k, (s, w) in enumerate(SCRIPT_WEIGHTS.items())], "ord int, script string, weight int")


def script_words(spark: SparkSession) -> DataFrame:
    """(script, code, lo, hi): the lookup chain from scripts over word lists to ranges."""
    rows = [(s, c, lo, hi) for s, codes in WORD_LISTS.items() for c in codes for lo, hi in BLOCKS[c]]
    return spark.createDataFrame(rows, "script string, code string, lo int, hi int")


def fold_variants(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(v, FOLDS.get(v, []), p) for v, p in PRIORITIES.items()], "variant string, folded array<string>, priority int")


def model_specs(spark: SparkSession, rows: list[dict]) -> DataFrame:
    return spark.createDataFrame(rows, schemas.MODEL_SPEC)


def asset_pins(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, schemas.ASSET_PIN)
