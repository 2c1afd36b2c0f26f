"""Money aggregates rounded to cents.

Three modes:

* ``decimal`` (default) -- whole cents within ``decimal(18,2)`` are summed as
  decimals, every other amount (a part of a cent, a very large one) by digits
  (:mod:`ledgerlake.functions.exact_sum`); both are exact, so the result does not
  depend on row order or partitioning.
* ``exact`` -- all amounts by digits: ``round(sum(double), 2)`` of the reference
  with the sum taken exactly, so its last bits do not depend on the order.  An
  average is that sum divided by the number of amounts, then rounded.
* ``double`` -- ``round(sum(double), 2)`` exactly as the reference computes it;
  the last bits depend on the order partial sums meet.

A group with an amount that has no digits (NaN, an infinity, 4.7e21 and more) is
summed as doubles in every mode: no row is dropped, and NaN propagates.

All are declarative aggregates with a fixed-width buffer, so Spark runs them
as a partial (map-side) + final HashAggregate.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlake.functions.exact_sum import DIGITS, digit_sums, exact_sum, fits, fold

CENTS = "decimal(18,2)"


def _column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _is_cents(c: Column) -> Column:
    """Whether an amount is exactly its ``CENTS`` value."""
    return F.coalesce(c.try_cast(CENTS).cast("double") == c.cast("double"), F.lit(False))


def _sum(c: Column, mode: str) -> tuple[Column, Column]:
    """The sum of the amounts of a group, and whether it is exact."""
    whole = c.cast("double")
    if mode == "exact":
        return exact_sum(whole), F.count_if(~fits(whole)) == 0
    cents = F.sum(F.when(_is_cents(c), c.try_cast(CENTS))).cast("double")     # of a mixed group
    other = F.when(~_is_cents(c), whole)
    rest = exact_sum(other)
    return F.when(rest.isNull(), cents).otherwise(F.coalesce(cents, F.lit(0.0)) + rest), F.count_if(~fits(other)) == 0


def _measure(agg, c: str | Column, mode: str) -> Column:
    c = _column(c)
    whole = c.cast("double")
    plain = F.round(agg(whole), 2)
    if mode == "double":
        return plain
    if mode not in ("decimal", "exact"):
        raise ValueError(f"unknown money mode {mode!r}")
    own, sure = _sum(c, mode)
    if agg is F.avg:
        own = F.try_divide(own, F.count(c))           # (without an amount both are null)
    own = F.when(sure, F.round(own, 2)).otherwise(plain)
    if mode == "exact":
        return own
    # a group of whole cents: all of it in decimals
    return F.when(F.count(c) == F.count_if(_is_cents(c)), F.round(agg(c.try_cast(CENTS)), 2).cast("double")).otherwise(own)


def total(c: str | Column = "amount", mode: str = "decimal") -> Column:
    return _measure(F.sum, c, mode)


def average(c: str | Column = "amount", mode: str = "decimal") -> Column:
    return _measure(F.avg, c, mode)


# -- mergeable parts: the measures of a coarser grouping from those of a finer one ------------------
PLAIN, AMOUNTS, OTHERS, WHOLE_CENTS, CENT_SUM = "plain", "amounts", "others", "whole_cents", "cent_sum"
DIGIT_SUMS = tuple(f"digit{k}" for k in range(DIGITS))


def parts(c: str | Column = "amount", mode: str = "decimal") -> list[Column]:
    """Aggregates of the amounts that add up over groups (:func:`merged_parts`)."""
    c = _column(c)
    whole = c.cast("double")
    out = [F.sum(whole).alias(PLAIN), F.count(c).alias(AMOUNTS)]
    if mode == "double":
        return out
    if mode not in ("decimal", "exact"):
        raise ValueError(f"unknown money mode {mode!r}")
    by_digits = whole if mode == "exact" else F.when(~_is_cents(c), whole)
    if mode == "decimal":
        out += [F.count_if(_is_cents(c)).alias(WHOLE_CENTS), F.sum(F.when(_is_cents(c), c.try_cast(CENTS))).alias(CENT_SUM)]
    return [*out, F.count_if(~fits(by_digits)).alias(OTHERS),
            *[s.alias(n) for s, n in zip(digit_sums(by_digits), DIGIT_SUMS, strict=True)]]


def part_names(mode: str = "decimal") -> list[str]:
    return [PLAIN, AMOUNTS, *([WHOLE_CENTS, CENT_SUM] if mode == "decimal" else []),
            *([] if mode == "double" else [OTHERS, *DIGIT_SUMS])]


def merged_parts(mode: str = "decimal") -> list[Column]:
    """The parts of a coarser grouping."""
    return [F.sum(n).alias(n) for n in part_names(mode)]


def sum_of_parts(mode: str = "decimal") -> Column:
    """The sum of a group's parts, not rounded, for :func:`total_of_parts` and :func:`average_of_parts`."""
    if mode == "double":
        return F.col(PLAIN)
    own = fold([F.col(n) for n in DIGIT_SUMS])
    if mode == "exact":
        return own
    cents = F.col(CENT_SUM).cast("double")
    return F.when(own.isNull(), cents).otherwise(F.coalesce(cents, F.lit(0.0)) + own)


def total_of_parts(own: str, mode: str = "decimal") -> Column:
    """:func:`total` from a group's parts and their sum, the column ``own``."""
    return _from_parts(own, mode, lambda s: s)


def average_of_parts(own: str, mode: str = "decimal") -> Column:
    """:func:`average` from a group's parts and their sum, the column ``own``."""
    return _from_parts(own, mode, lambda s: F.try_divide(s, F.col(AMOUNTS)))


def _from_parts(own: str, mode: str, measure) -> Column:
    plain = F.round(measure(F.col(PLAIN)), 2)
    if mode == "double":
        return plain
    out = F.when(F.col(OTHERS) == 0, F.round(measure(F.col(own)), 2)).otherwise(plain)
    if mode == "exact":
        return out
    # a group of whole cents: all of it in decimals (an average has six places before it is rounded)
    exact = F.round(measure(F.col(CENT_SUM)).cast("decimal(38,6)"), 2).cast("double")
    return F.when(F.col(AMOUNTS) == F.col(WHOLE_CENTS), exact).otherwise(out)
