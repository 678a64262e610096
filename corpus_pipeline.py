"""A pipeline over documents: each stage works on what the stage before it kept.

Each function takes (spark, docs, sf_dir) and returns a DataFrame; run() writes every stage's rows as Parquet in the
shared folder and reads them again for the next one, so a lost executor costs no more than the stage at work. The
rows of a stage are deleted once the next one is written; the last ones go when the application ends.

All stages but the last return all columns of docs in their order, whatever further ones there are and whatever
their names; an empty table gives an empty one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm import bpe, decontam, jaccard, quality, secret_scan
from lodestone.llm.common import table
from lodestone.llm.queries import BPE
from lodestone.session import discard, scratch


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the compression classifier, learnt from the labels, scores below its threshold.

    Null and empty texts get the share of good labels as their score, and so stay where most labels are good;
    repeated rows are scored alike, and all stay or go; a score that equals the threshold stays. Without labels of
    both kinds every document gets the share of the good ones, and without any label 1: all stay."""
    return quality.keep(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near duplicates.

    Null and empty texts and those without words are no duplicates of anything: all stay. Of rows with equal ids
    and texts one stays, any of them; among equal ids with different texts the smaller hash of the text decides. A
    null id comes last, so it stays only where its whole group has none."""
    return jaccard.dedup(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of a benchmark item, also of items without an id.

    Null and empty texts hold none and stay; repeated rows all go or stay; null and empty items have no windows,
    repeated ones change nothing; without items all stay."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"), unnamed=True)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces live-looking secrets in texts; n_chars, where there is such a column, follows the text.

    No row goes. Null and empty texts stay as they are (n_chars of a null text is null); repeated rows are replaced
    alike and count once as a repository; a null source counts as no owner; overlapping spans make one mark."""
    text = secret_scan.redact(docs)
    return text.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else text


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id and the ids of every text, with their number and the digests of the ids and of what they decode to.

    Null and empty texts have no ids, and the digests of nothing; every row gives one, also repeated ones and those
    with a null id; other columns are left behind."""
    encoded = bpe.encode(docs, public_tokenizers.path(BPE), public_tokenizers.PATTERN, decoded=True)
    return bpe.digests(encoded, "ids")


STAGES = [
    ("quality classifier", good_quality),
    ("n-gram Jaccard join", one_of_near_duplicates),
    ("benchmark decontamination", without_benchmark),
    ("secret scans", without_secrets),
    ("byte-level BPE encoding and decoding", tokens),
]

#: The quality classifier is learnt and MinHash is no SQL, so the rows are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = scratch(spark, "pipeline")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        if k:
            discard(spark, f"{folder}/{k - 1}")
    return docs
