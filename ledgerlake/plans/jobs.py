"""Batch jobs: ingest -> quality -> gold -> monitor, and all four in one run.

Layers go to a :class:`LayerStore` -- Parquet (or another format) paths
under a root folder, or catalog tables in a schema.  Each job reads the
previous layer back from the store (never from the source again), so every
layer is consistent with the ones derived from it and a failed job restarts
from the last written layer.  Row counts come from ``Observation``s attached
to the writes (in the stage that runs the write, so a retried task or stage
is counted once) and from Parquet footers, not from extra scans.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerlake import sinks
from ledgerlake.functions.rules import Profile, get_profile
from ledgerlake.operators import bronze as bronze_ops
from ledgerlake.operators import gold as gold_ops
from ledgerlake.operators import monitor
from ledgerlake.operators import quality as quality_ops
from ledgerlake.session import sorting_session

# ---------------------------------------------------------------------------
# Where each profile keeps its layers (paths / table names)
# ---------------------------------------------------------------------------
LAYOUTS = {
    "local": {
        "bronze": "bronze",
        "silver": "silver",
        "quarantine": "quarantine",
        "risk_rows": "gold/risk_scored_transactions",
        "daily": "gold/daily_transaction_metrics",
        "merchant": "gold/merchant_transaction_metrics",
        "country": "gold/country_transaction_metrics",
        "payment": "gold/payment_method_metrics",
        "risk_summary": "gold/risk_summary",
        "stream_bronze": "bronze",
    },
    "cloud": {
        "bronze": "bronze_transactions",
        "silver": "silver_transactions",
        "quarantine": "quarantine_transactions",
        "risk_rows": "gold_risk_scored_transactions",
        "daily": "gold_daily_metrics",
        "merchant": "gold_merchant_metrics",
        "country": "gold_country_metrics",
        "payment": "gold_payment_method_metrics",
        "risk_summary": "gold_risk_summary",
        "stream_bronze": "bronze_transactions_streaming",
    },
}
# ---------------------------------------------------------------------------
# ours: all five metric tables in one frame (see operators.gold.all_metrics)
METRICS_ALL = {"local": "gold/metrics_all", "cloud": "gold_metrics_all"}
# of bronze: a row group is read by one task, which sorts its rows to deduplicate them
SMALL_ROW_GROUPS = {"parquet.block.size": str(8 << 20)}
METRIC_LAYERS = ["daily", "merchant", "country", "payment", "risk_summary"]


@dataclass
class LayerStore:
    """Where layers live: ``root`` folder (paths) or ``schema`` (catalog tables).

    Layers are addressed by role (``bronze``, ``silver``, ``quarantine``,
    ``risk_rows``, the metric names, ``stream_bronze``); ``layout`` picks the
    profile's locations (default: the profile the job runs).  Table names use
    ``_`` where paths use ``/``.
    """
    spark: SparkSession
    root: str | None = None
    schema: str | None = None
    fmt: str = "parquet"
    layout: str | None = None

    def name(self, layer: str, profile: str | Profile | None = None) -> str:
        """Physical name of a layer role (an unknown role is used as given)."""
        layout = self.layout or (get_profile(profile).name if profile else "local")
        if layout == "rules":            # a rule set without layers of its own
            layout = "local"
        if layout not in LAYOUTS:
            raise ValueError(f"unknown layout {layout!r}: one of {sorted(LAYOUTS)}")
        if layer == "metrics_all":
            name = METRICS_ALL[layout]
        else:
            name = LAYOUTS[layout].get(layer, layer)
        return name.replace("/", "_") if self.schema else name

    def location(self, layer: str, profile: str | Profile | None = None) -> str:
        name = self.name(layer, profile)
        return f"{self.schema}.{name}" if self.schema else f"{self.root}/{name}"

    def write(self, df: DataFrame, layer: str, profile: str | Profile | None = None,
              partition_by: list[str] | None = None) -> None:
        if self.schema:
            sinks.create_schema(self.spark, self.schema)
            sinks.write_table(df, self.location(layer, profile), self.fmt, partition_by=partition_by)
        else:
            sinks.write_layer(df, self.location(layer, profile), self.fmt, partition_by=partition_by,
                              options=SMALL_ROW_GROUPS if layer == "bronze" and self.fmt == "parquet" else None)

    def read(self, layer: str, profile: str | Profile | None = None) -> DataFrame:
        if self.schema:
            return self.spark.table(self.location(layer, profile))
        return self.spark.read.format(self.fmt).load(self.location(layer, profile))

    def read_as(self, columns: StructType, layer: str, profile: str | Profile | None = None) -> DataFrame:
        """A layer of known columns: a partitioned one without rows has no file to tell them."""
        if self.schema:
            return self.read(layer, profile)
        return self.spark.read.schema(columns).format(self.fmt).load(self.location(layer, profile))


def _write_counted(store: LayerStore, df: DataFrame, layer: str, profile: Profile,
                   partition_by: list[str] | None = None) -> int:
    obs = Observation(layer)
    store.write(df.observe(obs, F.count(F.lit(1)).alias("rows")), layer, profile, partition_by)
    return int(obs.get["rows"])


def ingest(messages: DataFrame, store: LayerStore, profile: str | Profile = "local",
           keep_raw: bool = False) -> dict:
    """Bounded ingest: Kafka-shaped messages -> bronze (with the texts of malformed payloads: ``keep_raw``)."""
    p = get_profile(profile)
    rows = _write_counted(store, bronze_ops.bronze(messages, prefix=p.lineage_prefix, keep_raw=keep_raw),
                          "bronze", p)
    return {"bronze_records": rows}


def quality(store: LayerStore, profile: str | Profile = "local",
            deterministic: bool = True, dedup_method: str = "aggregate",
            into: LayerStore | None = None) -> dict:
    """bronze -> quarantine (every invalid row, with its reasons) and silver
    (valid rows, one per transaction_id), written to ``into`` (default: the same store)."""
    p = get_profile(profile)
    # a session of its own: the dedup sorts whole rows on both sides of its exchange, in tasks sized from the bronze bytes
    own = sorting_session(store.spark, store.read("bronze", p))
    target = replace(into or store, spark=own)
    store = replace(store, spark=own)
    bronze = store.read("bronze", p)
    validated = quality_ops.validate(bronze, p)
    seen = Observation("bronze")
    valid = quality_ops.split(validated, p)[0]
    # the map-only quarantine write reads every bronze row: count them there
    invalid = quality_ops.split(validated.observe(seen, F.count(F.lit(1)).alias("rows")), p)[1]
    order = quality_ops.survivor_order(p) if deterministic else None
    silver = quality_ops.shape_silver(
        quality_ops.dedup(valid, ["transaction_id"], order, dedup_method), p)
    if target.schema:
        sinks.create_schema(target.spark, target.schema)
    # The two outputs are independent jobs over bronze: submit them together
    # (the quarantine write is map-only), with the caller's job group and pool.
    counted = inheritable_thread_target(store.spark)(_write_counted)
    with ThreadPoolExecutor(max_workers=2) as pool:
        quarantined = pool.submit(counted, target, quality_ops.shape_quarantine(invalid, p),
                                  "quarantine", p)
        silvered = pool.submit(counted, target, silver, "silver", p)
        out = {"quarantined_records": quarantined.result(), "silver_records": silvered.result()}
    # The split is exhaustive and disjoint, so valid = bronze - quarantined.
    # (An observation placed before the dedup exchange would sit in a shuffle
    # map stage, whose metrics can be applied twice when a lost executor
    # forces the stage to re-run; write-stage observations are exact.)
    out["valid_before_dedup"] = int(seen.get["rows"]) - out["quarantined_records"]
    out["duplicates_removed"] = out["valid_before_dedup"] - out["silver_records"]
    return out


def gold(store: LayerStore, profile: str | Profile = "local",
         money_mode: str = "decimal") -> dict:
    """silver -> risk-scored rows -> the five metric tables."""
    p = get_profile(profile)
    out = {"gold_risk_records": _write_counted(
        store, gold_ops.add_risk(store.read("silver", p)), "risk_rows", p)}
    # one job for all five tables, then five splits: each reads the folder of its own metric only
    metrics = gold_ops.rolled_up_metrics(store.read("risk_rows", p), p, money_mode)
    out["gold_metric_groups"] = _write_counted(store, metrics, "metrics_all", p, ["metric"])
    combined = store.read_as(metrics.schema, "metrics_all", p)
    if store.schema:
        sinks.create_schema(store.spark, store.schema)
    # five independent writes: submitted together so their scheduling
    # latency overlaps (Spark runs jobs from separate threads concurrently)
    write = inheritable_thread_target(store.spark)(store.write)
    with ThreadPoolExecutor(max_workers=len(METRIC_LAYERS)) as pool:
        for done in [pool.submit(write, gold_ops.metric_from_all(combined, name, p), name, p)
                     for name in METRIC_LAYERS]:
            done.result()
    return out


def monitor_layers(store: LayerStore, metrics_path: str | None = None,
                   profile: str | Profile = "local", pipeline_name: str = monitor.PIPELINE_NAME) -> dict:
    """Reconcile the written layers into the monitoring record: computed once, the
    document holds what is returned."""
    p = get_profile(profile)
    metrics = monitor.monitoring_record(store.read("bronze", p), store.read("silver", p),
                                        store.read("quarantine", p), store.read("risk_rows", p),
                                        generated_at=True, pipeline_name=pipeline_name)
    row = metrics.first()
    if metrics_path:
        sinks.write_metrics_json(store.spark.createDataFrame([row], metrics.schema), metrics_path)
    return row.asDict()


def run_batch(spark: SparkSession, messages: DataFrame, store: LayerStore,
              profile: str | Profile = "local", deterministic: bool = True,
              money_mode: str = "decimal", metrics_path: str | None = None,
              dedup_method: str = "aggregate") -> dict:
    """All four jobs for one profile; returns the monitoring record plus the
    counts observed while writing."""
    counts = ingest(messages, store, profile)
    counts.update(quality(store, profile, deterministic, dedup_method))
    counts.update(gold(store, profile, money_mode))
    record = monitor_layers(store, metrics_path, profile)
    record["observed_counts"] = counts
    return record
