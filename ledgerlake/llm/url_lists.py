"""URL filters by a temporal list join.

List entries are dated: a pattern (a host or a parent domain) is added or
removed on a day.  Each pattern's entries become validity intervals, and a
capture is judged by the entries that were active when it was fetched: an as-of
join.  Both sides carry the pattern and the period (a fixed number of days), so
it is an equality join with a range check; a host that holds a third of all
captures meets the few intervals of its own period only, and Spark can split
its partition.

All of it is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import FILE, ROW, carried, located

PERIOD = 32      # days


def host_of(url: Column) -> Column:
    """The lower-case host; empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1))


def suffixes(host: Column) -> Column:
    """The host and its parent domains, of two labels or more."""
    labels = F.split(host, r"\.")
    return F.when(F.size(labels) < 2, F.array(host)).otherwise(F.transform(
        F.sequence(F.lit(1), F.size(labels) - 1),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels) - i + 1), ".")))


def validity(entries: DataFrame) -> DataFrame:
    """(list, pattern, valid_from, valid_to) from (list, pattern, day, action), ``action`` being
    ``add`` or ``remove``; days are integers; ``valid_to`` (exclusive) is null while active.

    Of entries on the same day ``remove`` wins.  Entries with a null are left out, and an
    entry that repeats the one before changes nothing.
    """
    daily = (entries.dropna(subset=["list", "pattern", "day", "action"])
             .groupBy("list", "pattern", "day").agg(F.max("action").alias("action")))
    w = Window.partitionBy("list", "pattern").orderBy("day")
    turns = daily.withColumn("before", F.lag("action").over(w)).where("before is null or before <> action")
    ends = turns.withColumn("valid_to", F.lead("day").over(w)).where("action = 'add'")
    return ends.select("list", "pattern", F.col("day").alias("valid_from"), "valid_to")


def judge(captures: DataFrame, intervals: DataFrame, id_col: str, url_col: str, day_col: str,
          last_day: int, period: int = PERIOD) -> DataFrame:
    """One row per row of ``captures``: its columns, ``host``, ``lists`` (those with an active
    entry, sorted), ``pattern`` (the longest active one) and ``blocked``.

    ``last_day``: the largest day of the captures, at which open intervals end.  Null ids,
    URLs or days give rows that are not blocked.  Columns of the captures with the names of
    the added ones are replaced.
    """
    captures = captures.drop("host", "lists", "pattern", "blocked")
    captures = located(captures)
    host = captures.withColumn("host", host_of(F.col(url_col)))
    asked = host.select(FILE, ROW, F.col(day_col).alias("day"), F.explode(suffixes(F.col("host"))).alias("pattern"))
    asked = asked.withColumn("period", F.floor(F.col("day") / period))
    upto = F.coalesce(F.col("valid_to"), F.lit(last_day + 1))
    active = intervals.withColumn("valid_to", upto).where("valid_to > valid_from").withColumn(
        "period", F.explode(F.sequence(F.floor(F.col("valid_from") / period), F.floor((F.col("valid_to") - 1) / period))))
    met = (asked.join(active, ["pattern", "period"]).where("day >= valid_from and day < valid_to")
           .groupBy(FILE, ROW).agg(F.sort_array(F.collect_set("list")).alias("lists"),
                                F.max(F.struct(F.length("pattern").alias("n"), "pattern")).alias("top")))
    return host.join(met, [FILE, ROW], "left").select(
        *carried(captures), "host",
        F.coalesce(F.array_join("lists", ","), F.lit("")).alias("lists"),
        F.col("top.pattern").alias("pattern"), F.col("lists").isNotNull().alias("blocked"))
