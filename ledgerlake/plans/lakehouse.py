"""The medallion plan: topic -> bronze -> silver / quarantine -> gold.

Each layer is a written table in the shared folder (``spark.checkpoint.dir``)
and every later layer reads it back, as the reference's separate jobs do:

* lineage is cut at every layer, so a lost executor only recomputes tasks of
  the stage it was running, never the JSON decode or the dedup shuffle of an
  earlier layer;
* Catalyst cannot push the quality filter below ``from_json`` and decode
  each message twice (it would, over a single lazy lineage);
* later jobs scan Parquet with column pruning and pushed filters.

Layers are written once per session, by the same batch jobs a user runs
(:mod:`ledgerlake.plans.jobs`: ingest, quality, gold) into a per-profile
:class:`LayerStore` with the profile's layout, and then shared by every query.
The jobs' write-time counts are kept in :attr:`Lakehouse.counts`.
"""

from __future__ import annotations

import hashlib
import os
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.rules import Profile, get_profile, is_valid
from ledgerlake.operators import bronze as bronze_ops
from ledgerlake.operators import gold as gold_ops
from ledgerlake.operators import quality as quality_ops
from ledgerlake.plans import jobs
from ledgerlake.plans.jobs import LayerStore
from ledgerlake.schema import KAFKA_SCHEMA
from ledgerlake.session import partitions_for, shared_dir
from ledgerlake.sources.orders_feed import (
    TOPIC,
    read_orders,
    transactions,
    transactions_from,
)

_LOCK = threading.RLock()
_REGISTRY: dict[tuple[str, str, str], "Lakehouse"] = {}


class Lakehouse:
    """Layers of one input folder, materialised under ``root``."""

    def __init__(self, spark: SparkSession, sf_dir: str, root: str | None = None,
                 dedup_method: str = "aggregate", money_mode: str = "decimal",
                 topic_partitions: int | None = None):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        if root is None:
            # The shared folder outlives sessions: scope the layers to this
            # application so no run ever reads (or resumes from) another's.
            tag = hashlib.sha1(os.path.abspath(self.sf_dir).encode()).hexdigest()[:12]
            app = spark.sparkContext.applicationId
            root = f"{shared_dir(spark)}/lakehouse-{app}-{tag}-{uuid.uuid4().hex[:8]}"
        self.root = root.rstrip("/")
        self.dedup_method = dedup_method
        self.money_mode = money_mode
        # How many files the stand-in topic is spread over (a topic's
        # partition count); the bronze decode runs one task per file.  By
        # default sized from the source (JSON text is ~30x the columnar bytes).
        self.topic_partitions = topic_partitions or partitions_for(
            spark, [f"{self.sf_dir}/orders.parquet"], expansion=30.0)
        self.counts: dict[str, dict] = {}      # per profile: the jobs' write-time counts
        self._written: set = set()

    # -- registry: one instance (one set of written layers) per session ----
    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str, **kw) -> "Lakehouse":
        key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir), repr(sorted(kw.items())))
        with _LOCK:
            if key not in _REGISTRY:
                _REGISTRY[key] = cls(spark, sf_dir, **kw)
            return _REGISTRY[key]

    @classmethod
    def adopt(cls, lake: "Lakehouse") -> "Lakehouse":
        """Make ``lake`` (already built) the session's instance for its folder."""
        key = (lake.spark.sparkContext.applicationId, os.path.abspath(lake.sf_dir), repr([]))
        with _LOCK:
            _REGISTRY[key] = lake
        return lake

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _materialise(self, name: str, build) -> DataFrame:
        path = self.path(name)
        with _LOCK:
            if name not in self._written:
                build().write.mode("overwrite").parquet(path)
                self._written.add(name)
        return self.spark.read.parquet(path)

    def store(self, profile: str | Profile = "local") -> LayerStore:
        """The profile's layers (the profile's own layout) under ``root``."""
        p = get_profile(profile)
        return LayerStore(self.spark, root=f"{self.root}/{p.name}", layout=p.name)

    def _run(self, p: Profile, job: str, fn) -> None:
        """Run one of the batch jobs once per session; keep its counts."""
        with _LOCK:
            if (p.name, job) not in self._written:
                self.counts.setdefault(p.name, {}).update(fn())
                self._written.add((p.name, job))

    # -- sources ------------------------------------------------------------
    def events(self) -> DataFrame:
        """Transaction events derived from ``orders`` (lazy)."""
        return transactions_from(self.spark, self.sf_dir)

    def encoded_messages(self, partitions: int | None = None) -> DataFrame:
        """Events as Kafka-shaped messages (lazy): the producer's output.

        With ``partitions`` the orders are first spread over that many tasks
        by a hash of their key (even however hot a transaction_id is, and
        deterministic on retry without the sort a round-robin repartition needs),
        so the JSON encoding runs in parallel whatever the source's file layout.
        An order's four columns take about a tenth of its event in that shuffle.
        """
        orders = read_orders(self.spark, self.sf_dir)
        ev = transactions(orders.repartition(partitions, "o_orderkey") if partitions else orders)
        ev = ev.withColumn("_ts", F.timestamp_seconds("sent_epoch"))
        return bronze_ops.encode_messages(ev, TOPIC, timestamp="_ts")

    def topic(self) -> DataFrame:
        """The message log, written once (stand-in for the broker topic),
        one file per topic partition."""
        self._materialise("topic", lambda: self.encoded_messages(self.topic_partitions))
        return self.spark.read.schema(KAFKA_SCHEMA).parquet(self.path("topic"))

    # -- layers: the batch jobs of plans.jobs, run once each ------------------
    def bronze(self, profile: str | Profile = "local") -> DataFrame:
        p = get_profile(profile)
        self._run(p, "ingest", lambda: jobs.ingest(self.topic(), self.store(p), p))
        return self.store(p).read("bronze", p)

    def _quality(self, p: Profile) -> None:
        self.bronze(p)
        self._run(p, "quality",
                  lambda: jobs.quality(self.store(p), p, dedup_method=self.dedup_method))

    def silver(self, profile: str | Profile = "local") -> DataFrame:
        p = get_profile(profile)
        self._quality(p)
        return self.store(p).read("silver", p)

    def quarantine(self, profile: str | Profile = "local") -> DataFrame:
        p = get_profile(profile)
        self._quality(p)
        return self.store(p).read("quarantine", p)

    def validated(self, profile: str | Profile = "local") -> DataFrame:
        """Bronze + error column (lazy over the written bronze)."""
        p = get_profile(profile)
        return quality_ops.validate(self.bronze(p), p)

    def valid_before_dedup(self, profile: str | Profile = "local") -> DataFrame:
        p = get_profile(profile)
        return self.validated(p).filter(is_valid(p))

    def _gold(self, p: Profile) -> None:
        self._quality(p)
        self._run(p, "gold", lambda: jobs.gold(self.store(p), p, self.money_mode))

    def risk_rows(self, profile: str | Profile = "local") -> DataFrame:
        """Gold risk-scored rows (written by the gold job)."""
        p = get_profile(profile)
        self._gold(p)
        return self.store(p).read("risk_rows", p)

    def gold_all(self, profile: str | Profile = "local") -> DataFrame:
        """All five metric tables in one written frame (one scan, one exchange)."""
        p = get_profile(profile)
        self._gold(p)
        return self.store(p).read("metrics_all", p)

    def gold(self, name: str, profile: str | Profile = "local") -> DataFrame:
        """One written gold metric table (with the profile's ordering)."""
        p = get_profile(profile)
        self._gold(p)
        table = self.store(p).read(name, p)
        return gold_ops.in_order(table, name, p) if p.sorted_gold else table
