"""Width batches over a stream, and windows over events."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def width_batches(rows: DataFrame, size: int, width: str = "width", id_: str = "id") -> DataFrame:
    """(width, batch, ids): a batch is emitted the moment a width has `size` rows; the remainder is carried on
    in the state of its width (size - 1 ids at most) from one trigger to the next and never expires."""

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held, done = (list(state.get[0]), state.get[1]) if state.exists else ([], 0)
        for frame in frames:
            held += frame["__id"].tolist()
            while len(held) >= size:
                yield pd.DataFrame({"width": [key[0]], "batch": [done], "ids": [held[:size]]})
                held, done = held[size:], done + 1
        state.update((held, done))

    named = rows.select(F.col(width).cast("long").alias("__width"), F.col(id_).cast("long").alias("__id"))
    return named.groupBy("__width").applyInPandasWithState(run, "width long, batch long, ids array<long>", "held array<long>, done long", "append", GroupStateTimeout.NoTimeout)


def event_windows(events: DataFrame, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Counts and sums by event type and window; events later than the watermark are left out."""
    by = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late).groupBy(F.window("ts", width).alias("w"), "event_type")
    return by.agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")


def read_stream(spark: SparkSession, path: str, schema, glob: str = "*.parquet", files: int = 1) -> DataFrame:
    """A stream of Parquet files, `files` per trigger."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).option("pathGlobFilter", glob).parquet(path)
