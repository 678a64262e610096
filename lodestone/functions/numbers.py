"""Scalar arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded(x: Column, digits: int) -> Column:
    """Rounded to the digits that are nearest to the binary value, exact ties to even.

    bround() and round() go by the printed decimal, which often is a tie where the binary value is none. Here twice
    x, scaled, is taken with the error of its product (Dekker, 1971): only where it is an odd integer is there a tie,
    and the error says on which side of it the value lies."""
    scale = 10.0**digits
    half = F.lit(2.0 * scale)
    product = x * half

    def parts(v: Column) -> tuple[Column, Column]:
        big = v * F.lit(134217729.0)
        high = big - (big - v)
        return high, v - high

    (a, b), (c, d) = parts(x), parts(half)
    error = ((a * c - product) + a * d + b * c) + b * d
    down, even = F.floor(product / 2.0).cast("double"), F.rint(product / 2.0)
    whole = F.when(product / 2.0 - down != 0.5, even).when(error > 0, down + 1.0).when(error < 0, down).otherwise(even)
    # numbers as large as this have no digits to lose; those that are none stay as they are
    return F.when(F.abs(product) < 2.0**53, whole / F.lit(scale)).otherwise(x)


def score_100(x: Column) -> Column:
    """A score of 0 to 1 on the scale of 0 to 100, one digit."""
    return rounded(x * F.lit(100.0), 1)


def sigmoid(x: Column, limit: float = 30.0) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-F.least(F.greatest(x, F.lit(-limit)), F.lit(limit))))


def weight_target(ratio: Column, mid: float = 0.075, k: float = 0.008) -> Column:
    return sigmoid((ratio - F.lit(mid)) / F.lit(k))


def padding(width: Column, multiple: int = 16) -> Column:
    return F.pmod(-width, F.lit(multiple))


def clip(x: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(x, F.lit(low)), F.lit(high))


def contrast_threshold(height: Column) -> Column:
    return F.lit(0.13) + F.lit(0.006) * F.greatest(F.lit(0.0), F.lit(30.0) - height)


def l2(*parts: Column) -> Column:
    total = F.lit(0.0)
    for x in parts:
        total = total + x * x
    return F.sqrt(total)


def skip_nan(x: Column) -> Column:
    """Null where x is NaN, so that aggregates skip it."""
    return F.when(~F.isnan(x), x)


def uniform(key: Column, salt: str = "") -> Column:
    """A uniform of 0 to 1 from the SHA-256 of a key: the same in any engine and any order."""
    return F.conv(F.substring(F.sha2(F.concat(key.cast("string"), F.lit(salt)).cast("binary"), 256), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
