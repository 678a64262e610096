"""Landed files: listings, contents, gzip and tar members, word lists, shards."""

from __future__ import annotations

import io
import tarfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions import binary as B
from lodestone.functions import text as X


def listing(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(name, path, size) of files; contents aren't read."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
    return df.select(X.name(F.col("path")).alias("name"), "path", F.col("length").alias("size"))


def hashed(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(name, path, size, sha256) of files."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
    return df.select(X.name(F.col("path")).alias("name"), "path", F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"))


def inflated(spark: SparkSession, path: str, glob: str = "*.gz") -> DataFrame:
    """(name, content, sha256) of gzip files, named without their last suffix, hashed as inflated."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    return df.select(X.stem(F.col("path")).alias("name"), B.inflate("content").alias("content")).withColumn("sha256", F.sha2("content", 256))


def tar_members(spark: SparkSession, path: str, glob: str = "*.tar*") -> DataFrame:
    """(archive, member, size, content) of the regular files of tar archives; unsafe names are left out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for archive, content in zip(batch["path"], batch["content"], strict=True):
                with tarfile.open(fileobj=io.BytesIO(content)) as tar:
                    for m in tar:
                        if m.isfile() and not m.name.startswith("/") and ".." not in m.name.split("/"):
                            yield pd.DataFrame({"archive": [archive], "member": [m.name], "size": [m.size], "content": [tar.extractfile(m).read()]})

    df = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", "content")
    return df.mapInPandas(run, "archive string, member string, size long, content binary")


def words(spark: SparkSession, path: str) -> DataFrame:
    """(line, value) of a word list; line keeps the order of the file, which is read in one piece."""
    df = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\r?\n")).alias("line", "value"))
    return df.filter("value != ''")


def shards(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Parquet shards with the columns asked for only."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def version(spark: SparkSession, path: str) -> DataFrame:
    """One row: the stripped content of a version file."""
    return spark.read.text(path, wholetext=True).select(X.strip(F.col("value")).alias("version"))


def register_udtf(spark: SparkSession) -> None:
    """SQL: SELECT * FROM tar_members(content) gives (member, size, content) of a tar archive's regular files."""
    from pyspark.sql.functions import udtf

    @udtf(returnType="member string, size long, content binary")
    class TarMembers:
        def eval(self, content):
            import io as io_
            import tarfile as tar_

            with tar_.open(fileobj=io_.BytesIO(content)) as tar:
                for m in tar:
                    if m.isfile() and not m.name.startswith("/") and ".." not in m.name.split("/"):
                        yield m.name, m.size, tar.extractfile(m).read()

    spark.udtf.register("tar_members", TarMembers)
