"""Shards, lineage, documents, sidecars, vocabularies and bundles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.functions import binary as B
from lodestone.functions import text as X


def write_shards(rows: DataFrame, path: str, shard: str = "shard") -> None:
    """Parquet, zstd, a folder per shard; rows of a shard in one task, so a shard is one file."""
    rows.repartition(shard).write.mode("overwrite").option("compression", "zstd").partitionBy(shard).parquet(path)


def write_lineage(rows: DataFrame, path: str, order: str = "index") -> None:
    """JSON lines in order: range-partitioned, so that part files follow each other."""
    rows.repartitionByRange(order).sortWithinPartitions(order).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def document(*fields: Column | str) -> Column:
    """A JSON document of the fields; nulls are left out."""
    return F.to_json(F.struct(*fields))


def write_documents(rows: DataFrame, path: str, value: str = "value") -> None:
    rows.select(value).write.mode("overwrite").text(path)


def write_each(rows: DataFrame, path: str, name: str, value: str = "value") -> None:
    """A text file for each row, in a folder of its name: readers of whole documents take one from each."""
    rows.select(name, value).write.mode("overwrite").partitionBy(name).text(path)


def write_files(rows: DataFrame, path: str, name: str = "name", content: str = "content") -> DataFrame:
    """Writes the content of every row to a file of its name below path, a URI or a path, on any file system that
    pyarrow knows, under a temporary name that is then moved: a task that runs twice leaves whole files. Returns
    (name, size); the files are there once it is read."""

    def run(batches):
        from uuid import uuid4

        from pyarrow import RecordBatch, array, fs, int64, string

        files, base = fs.FileSystem.from_uri(path) if ":" in path else (fs.LocalFileSystem(), path)
        files.create_dir(base, recursive=True)
        for batch in batches:
            names, sizes = batch.column(0).to_pylist(), []
            for to, data in zip(names, batch.column(1).to_pylist(), strict=True):
                temporary = f"{base}/.{uuid4().hex}"
                with files.open_output_stream(temporary, compression=None) as f:
                    f.write(data or b"")
                files.move(temporary, f"{base}/{to}")
                sizes.append(len(data or b""))
            yield RecordBatch.from_arrays([array(names, string()), array(sizes, int64())], ["name", "size"])

    return rows.select(F.col(name).alias("name"), F.col(content).alias("content")).mapInArrow(run, "name string, size long")


def catalog_groups(rows: DataFrame, fields: list[str], group: str = "group", pos: str = "pos") -> DataFrame:
    """(group, bidirectional, value): the directions of each group in order, as one JSON array.

    path, checksum and size are those of the group's first row, for every direction of it."""
    entries = F.array_sort(F.collect_list(F.struct(pos, *fields)))
    both = F.size("entries") > 1
    shared = [x for x in ("path", "checksum", "size") if x in fields]
    entry = lambda e: F.struct(*[(F.col("entries")[0][x] if x in shared else e[x]).alias(x) for x in fields], both.alias("bidirectional"))
    out = rows.groupBy(group).agg(entries.alias("entries"))
    return out.select(group, both.alias("bidirectional"), F.to_json(F.transform("entries", entry)).alias("value"))


def sidecars(files: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    """(path, value) of checksum files: only the last suffix of the name is swapped."""
    return files.select(X.with_suffix(F.col(path), ".sha256").alias("path"), F.concat(B.digest(F.col(content)), F.lit("  "), X.name(F.col(path))).alias("value"))


def write_keys(keys: DataFrame, path: str, pos: str = "pos", value: str = "value") -> int:
    """One character per line in order; returns how many, read from what was written."""
    keys.repartitionByRange(pos).sortWithinPartitions(pos).select(value).write.mode("overwrite").text(path)
    return keys.sparkSession.read.text(path).count()


def vocabulary(tokens: DataFrame, token: str = "token", token_id: str = "id") -> DataFrame:
    """One row: the binary vocabulary, entries by id. It is one value by its nature: a vocabulary must fit a task."""
    entry = B.vocabulary_entry(F.col(token), F.col(token_id))
    entries = F.array_sort(F.collect_list(F.struct(F.col(token_id).alias("id"), F.hex(entry).alias("e"))))
    return tokens.agg(F.unhex(F.array_join(F.transform(entries, lambda x: x["e"]), "")).alias("value"))


def bundle_members(files: DataFrame, root: str, name: str = "name") -> DataFrame:
    """The member list of an archive: flat names below root, sorted."""
    return files.select(F.concat(F.lit(f"{root}/"), X.name(F.col(name))).alias("member"), *[c for c in files.columns if c != "member"]).orderBy("member")


def tar_bundles(files: DataFrame, bundle: str = "bundle", name: str = "name", content: str = "content") -> DataFrame:
    """(bundle, content): a gzipped tar for each bundle, members sorted, times zero. A bundle must fit a task."""
    import pandas as pd

    def run(group: pd.DataFrame) -> pd.DataFrame:
        import gzip
        import io
        import tarfile

        raw = io.BytesIO()
        with tarfile.open(fileobj=raw, mode="w") as tar:
            for row in group.sort_values("n").itertuples():
                info = tarfile.TarInfo(row.n)
                info.size = len(row.c)
                tar.addfile(info, io.BytesIO(row.c))
        return pd.DataFrame({"bundle": [group["b"].iloc[0]], "content": [gzip.compress(raw.getvalue(), mtime=0)]})

    rows = files.select(F.col(bundle).alias("b"), F.col(name).alias("n"), F.col(content).alias("c"))
    return rows.groupBy("b").applyInPandas(run, "bundle string, content binary")


def report(metrics: DataFrame, model: str = "model", metric: str = "metric", value: str = "value") -> DataFrame:
    """(model, value): the metrics of each model as one JSON object, by name."""
    entries = F.map_from_entries(F.array_sort(F.collect_list(F.struct(metric, value))))
    return metrics.groupBy(model).agg(F.to_json(entries).alias("value"))


def write_versioned(rows: DataFrame, path: str, version: str) -> str:
    """Writes beside earlier versions, which stay as backups; returns the path."""
    to = f"{path}/version={version}"
    rows.write.mode("errorifexists").parquet(to)
    return to
