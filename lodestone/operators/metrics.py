"""Evaluation metrics. Inputs are long rows or arrays; NaN means not measurable and is skipped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.functions import arrays as A
from lodestone.functions import numbers as N
from lodestone.operators import dataset as D


def iou(a: Column, b: Column) -> Column:
    """Intersection over union of two boolean arrays; the union is 1 at least."""
    return A.count_true(A.both(a, b)).cast("double") / F.greatest(A.count_true(A.either(a, b)).cast("double"), F.lit(1.0))


def matte_iou(logits: Column, label: Column) -> Column:
    return iou(F.transform(logits, lambda x: N.sigmoid(x.cast("double")) > F.lit(0.5)), A.above(label, 0.5))


def soft_iou(inter: Column, union: Column) -> Column:
    return inter / (union + F.lit(1e-6))


def masked_mae(values: Column, truth: Column, mask: Column, least: int = 30) -> Column:
    """Mean absolute difference where mask holds; NaN below `least` places."""
    z = F.filter(F.arrays_zip(values.alias("v"), truth.alias("t"), mask.alias("m")), lambda x: x["m"])
    total = F.aggregate(z, F.lit(0.0), lambda s, x: s + F.abs(x["v"].cast("double") - x["t"].cast("double")))
    return F.when(F.size(z) >= least, total / F.size(z)).otherwise(F.lit(float("nan")))


def pairwise_auc(rows: DataFrame, keys: list[str], label: str, score: str, gap: float = 0.25) -> DataFrame:
    """Share of pairs, with one label below the other minus gap, that the score orders right; ties count half; NaN
    without such a pair. Exact over all pairs of a key without emitting any, and for any number of labels and scores.

    Rows are first summed up by label and score. The labels below a label's bound are the first e of all in
    order, which are at most log(labels) aligned ranges, one for each bit of e; every row stands in one range of each
    length. Within a range, running counts over the scores tell how many rows each score beats."""
    n = rows.filter(F.col(label).isNotNull() & F.col(score).isNotNull()).groupBy(*keys, F.col(label).cast("double").alias("__l"), F.col(score).alias("__s")).agg(F.count("*").alias("__c"))
    labels = n.select("__l").distinct()
    bits = max(1, labels.count().bit_length())
    both = labels.select(F.col("__l").alias("v"), F.lit(1).alias("kind"), "__l").union(labels.select(F.col("__l") - gap, F.lit(0), "__l"))
    ranked = D.running(both, [], ["v", "kind"], F.col("kind"), "rank")
    places = ranked.groupBy("__l").agg(F.max(F.when(F.col("kind") == 1, F.col("rank"))).alias("__r"), F.max(F.when(F.col("kind") == 0, F.col("rank"))).alias("__e"))
    at = n.join(places, "__l").withColumn("__j", F.explode(F.sequence(F.lit(0), F.lit(bits))))
    base = at.withColumn("__k", F.expr("shiftright(__r, __j)")).filter("__k % 2 = 0").select(*keys, "__j", "__k", "__s", F.col("__c").alias("__w"), F.lit(0).cast("long").alias("__q"))
    asked = at.filter("shiftright(__e, __j) % 2 = 1").select(*keys, "__j", F.expr("shiftright(__e, __j) - 1").alias("__k"), "__s", F.lit(0).cast("long").alias("__w"), F.col("__c").alias("__q"))
    met = base.union(asked).groupBy(*keys, "__j", "__k", "__s").agg(F.sum("__w").alias("__w"), F.sum("__q").alias("__q"))
    less = D.running(met, [*keys, "__j", "__k"], ["__s"], F.col("__w"), "__less")
    wins = F.sum(F.col("__q") * (F.col("__less") + F.col("__w") / 2.0))
    part = less.groupBy(*keys, "__j", "__k").agg(wins.alias("__x"), (F.sum("__q").cast("double") * F.sum("__w")).alias("__t"))
    out = part.groupBy(*keys).agg(F.sum("__x").alias("__x"), F.sum("__t").alias("__t"))
    all_ = rows.select(F.struct(*keys).alias("__key")).distinct()
    found = all_.join(out.select(F.struct(*keys).alias("__key"), "__x", "__t"), "__key", "left")
    return found.select(*[F.col(f"__key.`{k}`").alias(k) for k in keys], F.when(F.col("__t") > 0, F.col("__x") / F.col("__t")).otherwise(F.lit(float("nan"))).alias("auc"))


def summary(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Mean, 5th and 95th percentile and maximum of the values that aren't NaN."""
    v = N.skip_nan(F.col(value))
    return rows.groupBy(*keys).agg(F.avg(v).alias("mean"), F.percentile(v, F.lit(0.05)).alias("p5"), F.percentile(v, F.lit(0.95)).alias("p95"), F.max(v).alias("max"))


def mean_of_batch_means(rows: DataFrame, batch: str, value: Column, mask: Column) -> DataFrame:
    """Masked mean of each batch, then the mean of these with equal weight."""
    per = rows.groupBy(batch).agg((F.sum(mask.cast("double") * value) / (F.sum(mask.cast("double")) + 1e-6)).alias("m"))
    return per.agg(F.coalesce(F.avg("m"), F.lit(0.0)).alias("value"))


def running_loss(rows: DataFrame, step: str, loss: str, every: int = 25) -> DataFrame:
    return rows.groupBy(F.floor(F.col(step) / every).alias("window")).agg(F.avg(loss).alias("loss"))


def dice(p: str, t: str) -> Column:
    """Dice loss with +1 smoothing, as an aggregate."""
    return 1 - (2 * F.sum(F.col(p) * F.col(t)) + 1) / (F.sum(p) + F.sum(t) + 1)


def bce(p: str, t: str, tiny: float = 1e-7) -> Column:
    q = N.clip(F.col(p), tiny, 1 - tiny)
    return -F.avg(F.col(t) * F.log(q) + (1 - F.col(t)) * F.log(1 - q))


def combined_loss(parts: dict[str, Column], weights: dict[str, float]) -> Column:
    total = F.lit(0.0)
    for name, value in parts.items():
        total = total + value * F.lit(weights.get(name, 1.0))
    return total


def contrast(ink: Column, paper: Column) -> Column:
    """Largest difference of medians over channels; both are arrays of channels of arrays."""
    return F.array_max(F.zip_with(ink, paper, lambda a, b: F.abs(A.median(a) - A.median(b))))


def legible(ink: Column, paper: Column, height: Column, least: int = 30) -> Column:
    enough = (F.size(F.get(ink, F.lit(0))) >= least) & (F.size(F.get(paper, F.lit(0))) >= least)
    return F.coalesce(enough & (contrast(ink, paper) > N.contrast_threshold(height.cast("double"))), F.lit(False))


def parity(rows: DataFrame, ious: str, deltas: list[str]) -> DataFrame:
    """One row: mean IoU, and the mean over strips of their mean delta."""
    each = sum((F.col(d) for d in deltas), F.lit(0.0)) / len(deltas)
    return rows.agg(F.avg(ious).alias("iou"), F.avg(each).alias("delta"))


def nearest_corner(predicted: Column, true: Column) -> Column:
    """Each predicted corner to its nearest true one; the largest of these distances. Both arrays of (x, y)."""
    far = lambda p: F.array_min(F.transform(true, lambda q: F.sqrt((p["x"] - q["x"]) * (p["x"] - q["x"]) + (p["y"] - q["y"]) * (p["y"] - q["y"]))))
    return F.array_max(F.transform(predicted, far))


def stroke_ratio(mean_distance: Column, height: Column, ink: Column) -> Column:
    return F.when(ink < 20, F.lit(0.0)).otherwise(F.least(F.lit(2.0) * mean_distance / F.greatest(height, F.lit(1.0)), F.lit(0.45)))


def stroke_of(coverage: Column, distance: Column, width: Column) -> Column:
    """The stroke ratio of a flat coverage mask with the distance of each place to the nearest paper: the mean
    distance over ink (coverage above one half), and the height of the rows that hold ink."""
    def of(ink: Column) -> Column:
        total = F.aggregate(ink, F.lit(0.0), lambda s, x: s + x["d"].cast("double"))
        row = lambda x: F.floor(x / width)
        height = row(F.array_max(ink)["i"]) - row(F.array_min(ink)["i"]) + 1
        return F.when(F.size(ink) < 20, F.lit(0.0)).otherwise(stroke_ratio(total / F.size(ink), height.cast("double"), F.size(ink)))

    places = F.transform(F.arrays_zip(coverage.alias("c"), distance.alias("d")), lambda x, i: F.struct(i.alias("i"), x["c"].alias("c"), x["d"].alias("d")))
    return A.let(F.filter(places, lambda x: x["c"] > 0.5), of)


def region_color(rows: DataFrame, keys: list[str], channels: list[str], digits: int = 4) -> DataFrame:
    return rows.groupBy(*keys).agg(*[N.rounded(F.avg(c), digits).alias(c) for c in channels])


def throughput(count: Column, seconds: Column) -> Column:
    return count / F.nullif(seconds, F.lit(0.0))


def zipped(a: DataFrame, b: DataFrame, index: str) -> DataFrame:
    """Two results of the same rows, by an explicit index; clashing names of b get the prefix other_."""
    return a.join(b.withColumnsRenamed({c: f"other_{c}" for c in b.columns if c != index}), index)


def samples(coverage: Column, width: Column) -> Column:
    """struct<ink, paper>: places of ink and of paper in a flat coverage mask. Ink is above 0.6; paper below 0.05 in
    rows with ink, or else their k places of least coverage, empty where these are too few or inked. 400 places or
    so of each."""
    none = F.array().cast("array<int>")
    index = lambda xs: F.transform(xs, lambda x: x["i"])

    def of_rows(rows: Column) -> Column:
        bare = F.filter(rows, lambda x: x["c"] < 0.05)
        k = F.least(F.lit(400), F.greatest(F.lit(30), F.floor(F.size(rows) / 5).cast("int")), F.size(rows) - 1)
        lowest = F.slice(F.array_sort(rows), F.lit(1), F.greatest(k, F.lit(0)))
        instead = A.let(lowest, lambda x: F.when((k >= 30) & (F.coalesce(F.array_max(x)["c"], F.lit(1.0)) < 0.6), index(x)).otherwise(none))
        return F.when(F.size(bare) >= 30, index(bare)).otherwise(instead)

    def of_places(places: Column) -> Column:
        ink = F.filter(places, lambda x: x["c"] > 0.6)
        rows = A.let(F.array_distinct(F.transform(ink, lambda x: x["r"])), lambda inked: F.filter(places, lambda x: F.array_contains(inked, x["r"])))
        return F.struct(A.stride_sample(index(ink), 400).alias("ink"), A.stride_sample(A.let(rows, of_rows), 400).alias("paper"))

    return A.let(F.transform(coverage, lambda c, i: F.struct(c.alias("c"), i.alias("i"), F.floor(i / width).alias("r"))), of_places)


def legible_strip(coverage: Column, channels: Column, width: Column, height: Column) -> Column:
    """Whether ink and paper differ enough in some channel; channels are flat arrays like coverage."""
    pick = lambda places: lambda channel: F.transform(places, lambda i: F.get(channel, i))

    def of(x: Column) -> Column:
        return A.let(F.struct(F.transform(x["ch"], pick(x["s"]["ink"])).alias("ink"), F.transform(x["ch"], pick(x["s"]["paper"])).alias("paper")), lambda y: legible(y["ink"], y["paper"], height))

    return A.let(F.struct(samples(coverage, width).alias("s"), channels.alias("ch")), of)


def parameter_count(shapes: Column) -> Column:
    """Number of values in tensors of the given shapes (array of arrays), as an aggregate."""
    one = F.aggregate(shapes, F.lit(1).cast("long"), lambda a, n: a * n)
    return F.sum(one)
