"""Positions of rows in their groups, whatever the groups' sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import fresh, materialise, pieces_for


def places(df: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """``df`` with ``place`` (0 to ``size`` - 1 in its group, by the columns ``order``, nulls first)
    and ``size`` (rows of its group).  ``group`` must not be null.

    A window over the group would sort a group that holds a third of all rows in one task.  Here all
    rows are sorted by ranges of (group, order), so such a group spans many parts, and written once
    with their position in the part; the rows that each part has of each group, a few more than there
    are parts and groups, give where the part's share starts.  Rows equal in all columns of ``order``
    take the order of the input's partitions, which also splits them over parts.
    """
    tie, at, part = (fresh(df.columns, x) for x in ("tie", "at", "part"))
    rows = materialise(
        df.withColumn(tie, F.monotonically_increasing_id())
        .repartitionByRange(pieces_for(df), group, *order, tie)
        .sortWithinPartitions(group, *order, tie)
        .drop(tie).withColumn(at, F.monotonically_increasing_id()), name)
    rows = rows.withColumn(part, F.shiftrightunsigned(at, 33))
    shares = rows.select(F.col(part).alias("part"), F.col(f"`{group}`").alias("of"), F.col(at).alias("at"))
    shares = materialise(shares.groupBy("part", "of").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first")),
                         name + "-shares")
    own = Window.partitionBy("of")
    before = own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = shares.select("part", "of", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"),
                           F.sum("n").over(own).alias("size")).alias("s")
    on = [F.col(f"r.`{part}`") == F.col("s.part"), F.col(f"r.`{group}`") == F.col("s.of")]
    return rows.alias("r").join(starts, on).select(
        *[F.col(f"r.`{c}`") for c in df.columns],
        (F.col("s.before") + F.col(f"r.`{at}`") - F.col("s.first")).alias("place"), F.col("s.size").alias("size"))
