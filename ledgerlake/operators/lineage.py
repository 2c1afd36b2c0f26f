"""What the log positions tell: runs of offsets, and differences by content.

Both cut each topic partition into ranges of offsets, so the work is spread
over (partition, range) however few partitions a topic has; only a row or two
of each range meet by partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANGE = 1 << 16


def offset_runs(messages: DataFrame, partition: str = "partition", offset: str = "offset", size: int = RANGE) -> DataFrame:
    """Runs of consecutive offsets: ``partition``, ``first_offset``, ``last_offset``, ``rows``,
    ``repeats`` (rows beyond one for each offset) and ``missing`` (offsets to the next run; null after
    the last one of the partition).  Rows without a position are left out.

    Runs are found in each range; those that touch an edge of their range are joined with their
    neighbours, at most two a range.
    """
    of, at = F.col("partition"), F.col("offset")
    seen = (messages.select(F.col(partition).alias("partition"), F.col(offset).cast("long").alias("offset"))
            .where(of.isNotNull() & at.isNotNull()).groupBy("partition", "offset").agg(F.count(F.lit(1)).alias("n")))
    ranged = seen.withColumn("range", F.floor(at / size))
    own = Window.partitionBy("partition", "range").orderBy("offset")
    starts = F.when(F.lag("offset").over(own) == at - 1, 0).otherwise(1)
    runs = (ranged.withColumn("starts", starts).withColumn("run", F.sum("starts").over(own))
            .groupBy("partition", "range", "run").agg(
                F.min("offset").alias("first"), F.max("offset").alias("last"), F.sum("n").alias("rows"),
                F.count(F.lit(1)).alias("offsets")))
    low, high = F.col("range") * size, (F.col("range") + 1) * size - 1
    edge = (F.col("first") == low) | (F.col("last") == high)
    by_partition = Window.partitionBy("partition").orderBy("first")
    chained = (runs.where(edge)
               .withColumn("starts", F.when(F.lag("last").over(by_partition) == F.col("first") - 1, 0).otherwise(1))
               .withColumn("run", F.sum("starts").over(by_partition))
               .groupBy("partition", "run").agg(
                   F.min("first").alias("first"), F.max("last").alias("last"), F.sum("rows").alias("rows"),
                   F.sum("offsets").alias("offsets")))
    whole = runs.where(~edge).select("partition", "first", "last", "rows", "offsets").unionByName(chained.drop("run"))
    # where the next run starts: later in the range that this one starts in, or else with the partition's
    # next range in which a run starts (what a long run covers in between has no other start)
    whole = whole.withColumn("range", F.floor(F.col("first") / size))
    in_range = Window.partitionBy("partition", "range").orderBy("first")
    heads = whole.groupBy("partition", "range").agg(F.min("first").alias("head"))
    ranges = Window.partitionBy("partition").orderBy("range")
    follow = heads.select(F.col("partition").alias("p"), F.col("range").alias("h"), F.lead("head").over(ranges).alias("then"))
    found = whole.withColumn("next", F.lead("first").over(in_range)).join(
        follow, (F.col("partition") == F.col("p")) & (F.col("range") == F.col("h")))
    later = F.coalesce("next", "then")
    return found.select("partition", F.col("first").alias("first_offset"), F.col("last").alias("last_offset"), "rows",
                        (F.col("rows") - F.col("offsets")).alias("repeats"), (later - F.col("last") - 1).alias("missing"))


def _digests(columns: list[str]) -> tuple[Column, Column]:
    """Two hashes of a message's content; nulls count by their place."""
    spelled = F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns]), {"ignoreNullFields": "false"})
    return F.xxhash64(spelled), F.xxhash64(F.reverse(spelled), F.lit(1))


def content_differences(left: DataFrame, right: DataFrame, columns: list[str], partition: str = "partition",
                        offset: str = "offset", size: int = RANGE) -> DataFrame:
    """Log positions whose messages differ: ``partition``, ``offset``, ``kind`` (``lost``: not on the right,
    ``added``: not on the left, ``repeated``: the same message more or less often, ``altered``),
    ``left_rows`` and ``right_rows``.

    First each (partition, range of offsets) is summed up on both sides by its count and the sums of two
    hashes of its messages, whatever their order.  Only rows of ranges that differ are compared one by one.
    """
    def side(df: DataFrame) -> DataFrame:
        one, two = _digests(columns)
        at = F.col(f"`{offset}`").cast("long")
        return df.select(F.col(f"`{partition}`").alias("partition"), at.alias("offset"), F.floor(at / size).alias("range"),
                         one.alias("one"), two.alias("two"))

    def summed(df: DataFrame) -> DataFrame:
        whole = "decimal(20,0)"
        return df.groupBy("partition", "range").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("one").cast(whole)).alias("one"),
                                                    F.sum(F.col("two").cast(whole)).alias("two"))

    a, b = side(left), side(right)
    x, y = summed(a).alias("x"), summed(b).alias("y")
    on = F.col("x.partition").eqNullSafe(F.col("y.partition")) & F.col("x.range").eqNullSafe(F.col("y.range"))
    same = F.col("x.n").eqNullSafe(F.col("y.n")) & F.col("x.one").eqNullSafe(F.col("y.one")) & F.col("x.two").eqNullSafe(F.col("y.two"))
    differ = x.join(y, on, "full").where(~same).select(
        F.coalesce("x.partition", "y.partition").alias("p"), F.coalesce("x.range", "y.range").alias("r"))

    def suspects(df: DataFrame, rows: str) -> DataFrame:
        own = df.join(differ, F.col("partition").eqNullSafe(F.col("p")) & F.col("range").eqNullSafe(F.col("r")), "left_semi")
        return own.groupBy("partition", "offset").agg(
            F.count(F.lit(1)).alias(rows), F.array_sort(F.collect_set(F.struct("one", "two"))).alias("of_" + rows))

    m, n = suspects(a, "left_rows").alias("m"), suspects(b, "right_rows").alias("n")
    both = F.col("m.partition").eqNullSafe(F.col("n.partition")) & F.col("m.offset").eqNullSafe(F.col("n.offset"))
    kind = (F.when(F.col("right_rows").isNull(), F.lit("lost")).when(F.col("left_rows").isNull(), F.lit("added"))
            .when(F.col("of_left_rows") != F.col("of_right_rows"), F.lit("altered"))
            .when(F.col("left_rows") != F.col("right_rows"), F.lit("repeated")))
    return (m.join(n, both, "full").withColumn("kind", kind).where("kind IS NOT NULL")
            .select(F.coalesce("m.partition", "n.partition").alias("partition"), F.coalesce("m.offset", "n.offset").alias("offset"),
                    "kind", F.coalesce("left_rows", F.lit(0)).cast("long").alias("left_rows"),
                    F.coalesce("right_rows", F.lit(0)).cast("long").alias("right_rows")))
