"""Array functions: masks, samples, shapes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value computed once, however often use reads it, also inside of its lambdas."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def above(values: Column, threshold: float) -> Column:
    return F.transform(values, lambda v: v > F.lit(threshold))


def count_true(mask: Column) -> Column:
    return F.size(F.filter(mask, lambda v: v))


def both(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x & y)


def either(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x | y)


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, v: s + v.cast("double"))


def smallest(values: Column, k: Column | int) -> Column:
    return F.slice(F.array_sort(values), F.lit(1), F.least(F.lit(k) if isinstance(k, int) else k, F.size(values)))


def stride_sample(values: Column, most: int) -> Column:
    """Every n-th value, n so that about `most` are left."""

    def every(xs: Column) -> Column:
        stride = F.greatest(F.lit(1), F.floor(F.size(xs) / F.lit(most)).cast("int"))
        return F.filter(xs, lambda _, i: i % stride == 0)

    return let(values, every)


def median(values: Column) -> Column:
    def middle(s: Column) -> Column:
        n = F.size(s)
        return (F.get(s, ((n - 1) / 2).cast("int")).cast("double") + F.get(s, (n / 2).cast("int")).cast("double")) / F.lit(2.0)

    return let(F.array_sort(values), middle)


def transpose(rows: Column, width: int) -> Column:
    column = lambda k: F.transform(rows, lambda r: r[k])
    return F.array(*[column(k) for k in range(width)])


def padded(values: Column, width: Column, fill: Column) -> Column:
    return F.concat(values, F.array_repeat(fill, F.greatest(F.lit(0), width - F.size(values))))


def cropped(values: Column, width: Column) -> Column:
    return F.slice(values, F.lit(1), width)


def stacked(*arrays: Column) -> Column:
    return F.flatten(F.array(*arrays))


def first_of_each(entries: Column) -> Column:
    """{a: [3, 4]} as {a: 3}."""
    return F.transform_values(entries, lambda _, v: F.get(v, F.lit(0)))
