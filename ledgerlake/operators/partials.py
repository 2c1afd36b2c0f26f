"""Metrics over incremental loads: mergeable partial aggregates.

Each load writes one row per group: the number of rows and of amounts, and the
amounts' digit sums (:mod:`ledgerlake.functions.exact_sum`).  All are sums, so
merging the loads gives the metric over all rows, to the last bit, and a new
load reads its own rows only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.exact_sum import DIGITS, digit_sums, fits, fold

COUNTS = ("rows", "amounts", "others")
SUMS = tuple(f"digit{k}" for k in range(DIGITS))


def partials(df: DataFrame, keys: list[str], amount: str = "amount") -> DataFrame:
    """The partial aggregate of one load, one row per group."""
    c = F.col(amount).cast("double")
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"), F.count(c).alias("amounts"), F.count_if(~fits(c)).alias("others"),
        F.sum(F.when(~fits(c), c)).alias("other"), *[s.alias(n) for s, n in zip(digit_sums(c), SUMS, strict=True)])


def merged(loads: DataFrame, keys: list[str], total_name: str, average_name: str | None = None) -> DataFrame:
    """The metric over all loads: ``keys``, transaction_count, total and average of the amounts.
    Amounts without digits (NaN, infinities, very large ones) are added as doubles."""
    own = fold([F.sum(n) for n in SUMS])
    other = F.sum("other")
    total = F.when(own.isNull(), other).when(other.isNull(), own).otherwise(own + other)
    out = [F.sum("rows").alias("transaction_count"), F.round(total, 2).alias(total_name)]
    if average_name:
        out.append(F.round(F.try_divide(total, F.sum("amounts")), 2).alias(average_name))
    return loads.groupBy(*keys).agg(*out)


def add_load(df: DataFrame, path: str, load: int, keys: list[str], amount: str = "amount") -> None:
    """Write the partials of load number ``load``; writing a load again replaces it."""
    partials(df, keys, amount).write.mode("overwrite").parquet(f"{path}/load={load}")
