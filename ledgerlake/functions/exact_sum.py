"""Sums of doubles that do not depend on the order of adding.

A double is split into eight digits of 22 bits, by weight from 2^-104 to 2^50.
Each digit is a long, and so is its sum over a group: adding longs is exact, so
the sums combine in each task and across tasks in any order.  Per group the
eight sums are carried into plain digits and folded from the lowest to the
highest, always in this order: the result has the same bits however the rows
are split and shuffled, and is the exact sum but for the last rounding.

An amount fits if it is finite and under 2^72 (4.7e21).  What lies below 2^-104
of an amount is cut off row by row, so the order plays no part there either.
A digit's sum holds 2^41 rows of a group; beyond that Spark raises an error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BITS, LOWEST, DIGITS = 22, -104, 8
BASE = 1 << BITS


def weight(k: int) -> float:
    return 2.0 ** (LOWEST + BITS * k)


def fits(c: Column) -> Column:
    """Whether an amount can be split (false for NaN and infinities; null for null)."""
    return F.abs(c) < F.lit(weight(DIGITS))


def digits(c: Column) -> list[Column]:
    """The digits of an amount that fits, each with the amount's sign, lowest first; null for others."""
    own, sign = F.when(fits(c), F.abs(c)), F.when(c < 0, -1).otherwise(1)
    out = []
    for k in range(DIGITS):
        # the remainder and the division by a power of two are exact
        low = own if k == DIGITS - 1 else own % F.lit(weight(k + 1))
        out.append(F.floor(low * F.lit(1 / weight(k))) * sign)
    return out


def digit_sums(c: Column) -> list[Column]:
    """The aggregates to combine: a long for each digit (null if no amount fits)."""
    return [F.sum(d) for d in digits(c)]


def _plain(sums: Column) -> Column:
    """Digits from 0 to 2^22 - 1 and, last, what is carried beyond them, which bears the sign."""
    start = F.struct(F.lit(0).cast("long").alias("carry"), F.expr("cast(array() as array<bigint>)").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        whole = s + acc["carry"]
        return F.struct(F.shiftright(whole, BITS).alias("carry"),
                        F.concat(acc["out"], F.array(whole.bitwiseAND(F.lit(BASE - 1).cast("long")))).alias("out"))

    return F.aggregate(sums, start, step, lambda acc: F.concat(acc["out"], F.array(acc["carry"])))


def _folded(plain: Column) -> Column:
    weights = F.array(*[F.lit(weight(k)) for k in range(DIGITS + 1)])
    parts = F.zip_with(plain, weights, lambda d, w: d.cast("double") * w)
    return F.aggregate(parts, F.lit(0.0), lambda acc, x: acc + x)


def fold(sums: list[Column]) -> Column:
    """The sum as a double, from the digits' sums (null if they are null)."""
    whole = F.array(*sums)
    plain, other = _plain(whole), _plain(F.transform(whole, lambda s: -s))
    negative = F.element_at(plain, -1) < 0
    return F.when(sums[0].isNotNull(), F.when(negative, -_folded(other)).otherwise(_folded(plain)))


def exact_sum(c: Column) -> Column:
    """The sum of the amounts of a group that fit, with the same bits in any order."""
    return fold(digit_sums(c))
