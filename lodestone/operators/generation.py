"""Synthetic samples: each from a generator seeded by its own id, so any order and any task gives the same."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from random import Random

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def generate(ids: DataFrame, make: Callable[[Random], dict], accept: Callable[[dict], bool], schema: str, id_: str = "id", seed: int = 0, tries: int = 12) -> DataFrame:
    """A sample for every id: made anew until accepted, and after `tries` the last one as it is.

    schema names the id, the keys of make, and `tries` and `accepted` at the end."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for value in frame[id_]:
                rng = Random(f"{seed}:{value}")
                for n in range(1, tries + 1):
                    sample = make(rng)
                    good = accept(sample)
                    if good:
                        break
                out.append({id_: value} | sample | {"tries": n, "accepted": good})
            yield pd.DataFrame(out, columns=names)

    names = [x.strip().split()[0] for x in schema.split(",")]
    return ids.select(id_).mapInPandas(run, schema)


def shaded(pixels: Column, width: Column, gain: Column) -> Column:
    """Light that falls off from left to right: pixel times 1 + gain (x / width - 1/2), clipped to 0..1."""
    return F.transform(pixels, lambda p, i: F.least(F.greatest(p.cast("double") * (F.lit(1.0) + gain * ((i % width) / width - F.lit(0.5))), F.lit(0.0)), F.lit(1.0)))


def squeezed(pixels: Column, factor: Column) -> Column:
    """Contrast squeezed around one half."""
    return F.transform(pixels, lambda p: F.lit(0.5) + (p.cast("double") - F.lit(0.5)) * factor)


def shadowed(pixels: Column, width: Column, start: Column, strength: Column) -> Column:
    """Columns from start on are darker by strength."""
    return F.transform(pixels, lambda p, i: F.when(i % width >= start, p.cast("double") * (F.lit(1.0) - strength)).otherwise(p.cast("double")))


def script_fallback(words: DataFrame, chains: DataFrame, count: int = 200) -> DataFrame:
    """(script, word): the words of each script's lists; a script without any gets the first code points of its
    first range. words: (code, word); chains: (script, code, lo, hi), a literal table."""
    own = chains.select("script", "code").distinct().join(words, "code").select("script", "word")
    first = chains.groupBy("script").agg(F.min(F.struct("lo", "hi")).alias("b"))
    bare = first.join(own.select("script").distinct(), "script", "left_anti")
    points = bare.select("script", F.explode(F.sequence("b.lo", F.least(F.col("b.hi"), F.col("b.lo") + count - 1))).alias("p"))
    char = F.decode(F.unhex(F.lpad(F.hex(F.col("p").cast("long")), 8, "0")), "UTF-32")
    return own.unionByName(points.select("script", char.alias("word")))
