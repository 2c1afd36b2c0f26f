"""Sharding by a Feistel permutation of global row numbers, with cycle walking.

Rows are numbered 0 .. n-1 in the order of a key.  A number goes through an
alternating Feistel network over Z_a x Z_b with a = ceil(sqrt(n)) and
b = ceil(n / a) (J. Black, P. Rogaway, "Ciphers with Arbitrary Finite Domains",
2002); a result outside 0 .. n-1 goes through again until it is inside, which
keeps it a permutation.  Place p in the shuffled order is slot p div s of shard
p mod s, so shards differ by a row at most.  The shuffle depends on the keys'
order, the number of rows and the seed alone; a row's shard and slot can be
computed from its number, and its number from shard and slot.

All of it is SQL functions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import fresh, numbered

ROUNDS, SEED = 6, 20240501
MOST_WALK = 64


def radices(n: int) -> tuple[int, int]:
    """a and b with a * b >= n and a * b - n < a."""
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    return a, max(1, -(-n // a))


def _network(x: str, n: int, seed: int, forward: bool) -> str:
    a, b = radices(n)
    mixed = "cast(conv(substr(md5(concat({seed}, ':', i, ':', {v})), 1, 15), 16, 10) as bigint)"
    sign = "+" if forward else "-"
    left, right = (mixed.format(seed=seed, v=v) for v in ("s.l", "s.r"))
    order = f"sequence(0, {ROUNDS - 1})" if forward else f"sequence({ROUNDS - 1}, 0, -1)"
    return (f"aggregate({order}, named_struct('l', {x} div {b}L, 'r', {x} % {b}L), (s, i) -> if(i % 2 = 0, "
            f"named_struct('l', pmod(s.l {sign} {right} % {a}L, {a}L), 'r', s.r), "
            f"named_struct('l', s.l, 'r', pmod(s.r {sign} {left} % {b}L, {b}L))), s -> s.l * {b}L + s.r)")


def permuted(column: str, n: int, seed: int = SEED, forward: bool = True) -> Column:
    """The place of row number ``column`` among ``n`` (or, backward, the number at a place).

    A walk leaves 0 .. n-1 for at most a * b - n steps.  That is the bound for small
    ``n``; for others fewer than one step in 60 leaves, and a walk of 64 steps outside
    (odds below 1e-110) would be an error, never a wrong place.
    """
    a, b = radices(n)
    steps = min(a * b - n + 1, MOST_WALK)
    walk = f"if(k > 1 and x < {n}L, x, {_network('x', n, seed, forward)})"
    return F.expr(f"aggregate(sequence(1, {steps}), cast({column} as bigint), (x, k) -> {walk}, "
                  f"x -> if(x < {n}L, x, cast(raise_error('the walk is too long: choose another seed') as bigint)))")


def shard(df: DataFrame, order: list[str], shards: int, seed: int = SEED) -> DataFrame:
    """``df`` with ``row_number``, ``shard`` and ``slot``.  Nulls come first in the order; rows
    with equal keys keep the order of the input's partitions.  Columns of these names are replaced."""
    rows, n = numbered(df.drop("row_number", "shard", "slot"), order, "sharded")
    at = fresh(rows.columns, "place")
    return rows.withColumn(at, permuted("row_number", max(n, 1), seed)).withColumns({
        "shard": (F.col(at) % shards).cast("int"),
        "slot": F.expr(f"{at} div {shards}")}).drop(at)


def number_at(shard_col: str, slot_col: str, n: int, shards: int, seed: int = SEED) -> Column:
    """The row number at a slot of a shard."""
    return permuted(f"({slot_col} * {shards}L + {shard_col})", n, seed, forward=False)
