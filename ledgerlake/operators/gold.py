"""Gold layer: risk-scored rows and the grouped business metrics.

Every metric is a grouped aggregate with algebraic measures (count, decimal
sum, decimal avg), so Spark plans ``partial HashAggregate -> Exchange(hash
on the keys) -> final HashAggregate``; :func:`rolled_up_metrics` computes all five
tables with three of these, :func:`all_metrics` with one scan and one exchange
(grouping sets, every row five times).  Map-side combining makes a skewed
key (one country holding most rows) harmless: each map task ships at most
one partial row per key.  An output has a row per group (a merchant table as
many as there are merchants); its optional sort is a range exchange of those.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from ledgerlake.functions import money
from ledgerlake.functions.risk import risk_level, risk_score
from ledgerlake.functions.rules import Profile, get_profile, parse_event_time


def add_risk(df: DataFrame, **kw) -> DataFrame:
    """Silver + ``risk_score`` (int) + ``risk_level`` (HIGH / MEDIUM / LOW)."""
    return (df.withColumn("risk_score", risk_score(**kw))
              .withColumn("risk_level", risk_level()))


def transaction_date(profile: str | Profile = "local") -> Column:
    """Calendar day (session time zone, UTC) of the event.

    local silver already holds a parsed timestamp; cloud silver keeps the
    text, parsed here -- an unparsable text gives the NULL-date group instead
    of failing the job.
    """
    p = get_profile(profile)
    ts = F.col("event_timestamp")
    return F.to_date(ts if p.parse_timestamp else parse_event_time(ts))


@dataclass(frozen=True)
class MetricSpec:
    name: str
    keys: tuple[str, ...]
    average: bool
    order: tuple[tuple[str, bool], ...]   # (column, descending); local only


def metric_specs(profile: str | Profile = "local") -> dict[str, MetricSpec]:
    p = get_profile(profile)
    total, count = p.total_name, "transaction_count"
    return {
        "daily": MetricSpec("daily", ("transaction_date",), p.daily_average,
                            (("transaction_date", False),)),
        "merchant": MetricSpec("merchant", p.merchant_keys, p.daily_average,
                               ((total, True),) + tuple((k, False) for k in p.merchant_keys)),
        "country": MetricSpec("country", ("country",), True,
                              ((total, True), ("country", False))),
        "payment": MetricSpec("payment", ("payment_method",), False,
                              ((count, True), ("payment_method", False))),
        "risk_summary": MetricSpec("risk_summary", ("risk_level",), False,
                                   (("risk_level", False),)),
    }


def metrics(df: DataFrame, keys: list[str] | tuple[str, ...], total_name: str,
            average_name: str | None = None, money_mode: str = "decimal") -> DataFrame:
    """``keys`` -> transaction_count, total (and average) of ``amount``."""
    measures = [F.count(F.lit(1)).alias("transaction_count"),
                money.total("amount", money_mode).alias(total_name)]
    if average_name:
        measures.append(money.average("amount", money_mode).alias(average_name))
    return df.groupBy(*keys).agg(*measures)


def gold_metric(risk_rows: DataFrame, name: str, profile: str | Profile = "local",
                money_mode: str = "decimal", sort: bool | None = None) -> DataFrame:
    """One of daily / merchant / country / payment / risk_summary.

    ``sort`` defaults to the profile (local tables are ordered, cloud ones
    are not); ties in the ordering column are broken by the grouping keys so
    the order is total.
    """
    p = get_profile(profile)
    spec = metric_specs(p)[name]
    src = risk_rows
    if name == "daily":
        src = risk_rows.withColumn("transaction_date", transaction_date(p))
    out = metrics(src, spec.keys, p.total_name,
                  p.average_name if spec.average else None, money_mode)
    if p.sorted_gold if sort is None else sort:
        out = out.orderBy(*[F.col(c).desc() if desc else F.col(c).asc()
                            for c, desc in spec.order])
    return out


def _key_columns(specs: dict[str, MetricSpec]) -> list[str]:
    cols: list[str] = []
    for spec in specs.values():
        cols += [k for k in spec.keys if k not in cols]
    return cols


def all_metrics(risk_rows: DataFrame, profile: str | Profile = "local",
                money_mode: str = "decimal") -> DataFrame:
    """All five metric tables from ONE scan and ONE exchange.

    ``GROUPING SETS`` over the five key sets: Spark expands each row once per
    set, aggregates partially map-side, shuffles only the partial rows and
    finishes the aggregates -- instead of five jobs each re-reading the risk
    rows.  ``metric`` names the table a row belongs to; keys outside that
    table's set are NULL.  The result has one row per group; written partitioned
    by ``metric``, each table is split off by reading its own folder.
    """
    p = get_profile(profile)
    specs = metric_specs(p)
    cols = _key_columns(specs)
    # grouping_id(): bit (n-1-i) is set when column i is not in the set
    gid = {name: sum(1 << (len(cols) - 1 - i) for i, c in enumerate(cols) if c not in spec.keys)
           for name, spec in specs.items()}
    metric = None
    for name, g in gid.items():
        metric = (F.when(F.grouping_id() == g, F.lit(name)) if metric is None
                  else metric.when(F.grouping_id() == g, F.lit(name)))
    src = risk_rows.withColumn("transaction_date", transaction_date(p))
    return (src.groupingSets([list(spec.keys) for spec in specs.values()], *cols)
               .agg(metric.alias("metric"),
                    F.count(F.lit(1)).alias("transaction_count"),
                    money.total("amount", money_mode).alias(p.total_name),
                    money.average("amount", money_mode).alias(p.average_name)))


# the tables with few groups each: their common grain is small too
SMALL = ("country", "payment", "risk_summary")


def rolled_up_metrics(risk_rows: DataFrame, profile: str | Profile = "local",
                      money_mode: str = "decimal") -> DataFrame:
    """:func:`all_metrics` without multiplying the rows.

    Three aggregates, each over its own columns: by day, by merchant, and by
    (country, payment method, risk level), whose few groups hold mergeable
    parts (:func:`ledgerlake.functions.money.parts`) from which the three small
    tables are added up.  The exchange of that grain is planned once and reused.

    The day is not part of the grain: days x countries x methods x levels is
    more groups than a task has rows to combine, and each would be shuffled.
    """
    p = get_profile(profile)
    specs = metric_specs(p)
    cols = _key_columns(specs)
    types = {c: risk_rows.schema[c].dataType for c in cols if c in risk_rows.columns} | {"transaction_date": DateType()}

    n = "transaction_count"

    def groups(name: str) -> DataFrame:
        keys = specs[name].keys
        if name in SMALL:
            return small.groupBy(*keys).agg(F.sum(n).alias(n), *money.merged_parts(money_mode))
        src = risk_rows.withColumn("transaction_date", transaction_date(p)) if name == "daily" else risk_rows
        return src.groupBy(*keys).agg(*measures)

    def shaped(name: str) -> DataFrame:
        keys = [F.col(c) if c in specs[name].keys else F.lit(None).cast(types[c]).alias(c) for c in cols]
        return groups(name).select(*keys, F.lit(name).alias("metric"), n, *money.part_names(money_mode))

    measures = [F.count(F.lit(1)).alias(n), *money.parts("amount", money_mode)]
    small = risk_rows.groupBy(*[k for name in SMALL for k in specs[name].keys]).agg(*measures)
    # the parts of all tables are folded by one projection
    return reduce(DataFrame.unionByName, [shaped(name) for name in specs]).withColumn(
        "own", money.sum_of_parts(money_mode)).select(
        *cols, "metric", n, money.total_of_parts("own", money_mode).alias(p.total_name),
        money.average_of_parts("own", money_mode).alias(p.average_name))


def metric_from_all(combined: DataFrame, name: str, profile: str | Profile = "local",
                    sort: bool | None = None) -> DataFrame:
    """One metric table out of :func:`all_metrics` (same columns and order as
    :func:`gold_metric`)."""
    p = get_profile(profile)
    spec = metric_specs(p)[name]
    measures = ["transaction_count", p.total_name] + ([p.average_name] if spec.average else [])
    out = combined.filter(F.col("metric") == name).select(*spec.keys, *measures)
    return in_order(out, name, p) if (p.sorted_gold if sort is None else sort) else out


def in_order(table: DataFrame, name: str, profile: str | Profile = "local") -> DataFrame:
    """A metric table in its order (a written table keeps no order of its rows)."""
    return table.orderBy(*[F.col(c).desc() if desc else F.col(c).asc()
                           for c, desc in metric_specs(profile)[name].order])


def gold_tables(silver_df: DataFrame, profile: str | Profile = "local",
                money_mode: str = "decimal") -> dict[str, DataFrame]:
    """risk rows + the five metric tables of the profile (all lazy; the five
    share one grouping-sets aggregate -- write or cache ``all_metrics`` first
    when several of them are materialised)."""
    p = get_profile(profile)
    risk_rows = add_risk(silver_df)
    combined = all_metrics(risk_rows, p, money_mode)
    out = {"risk_rows": risk_rows}
    for name in metric_specs(p):
        out[name] = metric_from_all(combined, name, p)
    return out


def top(df: DataFrame, k: int = 20, order: list[Column] | None = None) -> DataFrame:
    """The first ``k`` rows by ``order`` (a preview / top-k report).

    ``orderBy(...).limit(k)`` is planned as TakeOrderedAndProject: each task
    keeps its own top ``k`` and only those are merged, no full sort.
    """
    return (df.orderBy(*order) if order else df).limit(k)


def total_value(silver_df: DataFrame, money_mode: str = "decimal") -> DataFrame:
    """Sum of all silver amounts, one row."""
    return silver_df.agg(money.total("amount", money_mode).alias("total_transaction_value"))
