"""Registered queries: one per operator group of the inventory.

Each builder takes ``(spark, sf_dir)`` and returns a DataFrame over the
layers of :class:`Lakehouse` (written once per session, shared by all
queries).  Outputs are projected to engine-neutral types for the oracle
check: money as double, counts as bigint, timestamps as epoch seconds, the
per-run ``ingestion_timestamp`` and the constant source timestamp dropped.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake import sinks
from ledgerlake.functions.rules import get_profile
from ledgerlake.operators import bronze as bronze_ops
from ledgerlake.operators import lineage, monitor
from ledgerlake.operators import quality as quality_ops
from ledgerlake.plans import jobs
from ledgerlake.plans.lakehouse import Lakehouse
from ledgerlake.schema import EVENT_FIELDS

Builder = Callable[[SparkSession, str], DataFrame]

_NON_TIME = [f for f in EVENT_FIELDS if f != "event_timestamp"]


def _lake(spark: SparkSession, sf_dir: str) -> Lakehouse:
    return Lakehouse.of(spark, sf_dir)


def _lineage(profile: str) -> list[str]:
    pre = get_profile(profile).lineage_prefix
    return [f"{pre}_partition", f"{pre}_offset"]


def _event_epoch() -> F.Column:
    return F.unix_seconds(F.col("event_timestamp")).alias("event_epoch")


# -- sources / ingest --------------------------------------------------------
def transactions(spark, sf_dir):
    return _lake(spark, sf_dir).events()


def raw_messages(spark, sf_dir):
    raw = bronze_ops.raw_messages(_lake(spark, sf_dir).topic())
    return (raw.withColumn("timestamp_epoch", F.unix_seconds(F.col("timestamp")))
               .drop("timestamp"))


def bronze_roundtrip(spark, sf_dir):
    b = _lake(spark, sf_dir).bronze("local")
    return b.select(*EVENT_FIELDS, *_lineage("local"))


def _stream_bronze(spark, sf_dir) -> DataFrame:
    from ledgerlake.streaming.ingest import run_bronze_stream
    lake = _lake(spark, sf_dir)
    lake.topic()
    sink, _ = run_bronze_stream(spark, lake.path("topic"), lake.path("stream_run"),
                                prefix="kafka")
    return spark.read.parquet(sink)


def bronze_stream(spark, sf_dir):
    return _stream_bronze(spark, sf_dir).select(*EVENT_FIELDS, *_lineage("local"))


def batch_stream_reconcile(spark, sf_dir):
    return monitor.batch_stream_reconcile(_lake(spark, sf_dir).bronze("local"),
                                          _stream_bronze(spark, sf_dir))


def _fresh(lake: Lakehouse, name: str) -> str:
    """A new folder, also if the query runs again."""
    return lake.path(f"{name}-{uuid.uuid4().hex[:8]}")


def bronze_stream_resume(spark, sf_dir):
    """Half the topic, a run; the other half, a second run that goes on from the first."""
    from ledgerlake.streaming.ingest import run_bronze_stream
    lake = _lake(spark, sf_dir)
    run = _fresh(lake, "resume")
    for half in (0, 1):
        lake.topic().where(F.col("partition") % 2 == half).write.mode("append").parquet(f"{run}/topic")
        sink, _ = run_bronze_stream(spark, f"{run}/topic", run)
    return spark.read.parquet(sink).select(*EVENT_FIELDS, *_lineage("local"))


def bronze_stream_table_cloud(spark, sf_dir):
    from ledgerlake.streaming.ingest import run_bronze_stream
    lake = _lake(spark, sf_dir)
    lake.topic()
    schema = f"stream_{uuid.uuid4().hex[:8]}"
    sinks.create_schema(spark, schema)
    name = f"{schema}.bronze"
    run_bronze_stream(spark, lake.path("topic"), _fresh(lake, "stream_table"), prefix="eventhub", table=name)
    return spark.table(name).select(*EVENT_FIELDS, *_lineage("cloud"))


def stream_report(spark, sf_dir):
    """Input rows over all micro-batches of a fresh run, and the rows it wrote."""
    from ledgerlake.streaming.ingest import bronze_stream_from_files, run_with_totals, start_stream
    lake = _lake(spark, sf_dir)
    lake.topic()
    run = _fresh(lake, "report")
    stream = bronze_stream_from_files(spark, lake.path("topic"))
    _, totals = run_with_totals(spark, lambda: start_stream(stream, f"{run}/checkpoint", f"{run}/bronze"))
    return spark.read.parquet(f"{run}/bronze").agg(
        F.lit(totals["input_rows"]).cast("long").alias("input_rows"), F.count(F.lit(1)).alias("bronze_rows"))


def events_from_json(spark, sf_dir):
    """Events written as JSON arrays, an array a file, and read back."""
    from ledgerlake.sources.files import read_event_json
    lake = _lake(spark, sf_dir)
    path = _fresh(lake, "events-json")
    event = F.struct(*EVENT_FIELDS)
    # as many events in a file as fit one task: a file of many lines is not split
    arrays = lake.events().groupBy(F.floor(F.col("offset") / 10_000).alias("file")).agg(
        F.to_json(F.collect_list(event), {"ignoreNullFields": "false"}).alias("value"))
    arrays.write.partitionBy("file").text(path)
    return read_event_json(spark, path).select(*EVENT_FIELDS)


def ingestion_stamp(spark, sf_dir):
    stamp = F.col("ingestion_timestamp")
    return _lake(spark, sf_dir).bronze("local").agg(
        F.count_if(stamp.isNull()).alias("null_stamps"), F.count_distinct(stamp).alias("stamps"))


# -- quality -----------------------------------------------------------------
def silver_table_cloud(spark, sf_dir):
    """Bronze and silver as catalog tables."""
    store = jobs.LayerStore(spark, schema=f"lake_{uuid.uuid4().hex[:8]}")
    jobs.ingest(_lake(spark, sf_dir).topic(), store, "cloud")
    jobs.quality(store, "cloud")
    return store.read("silver", "cloud").select(
        *EVENT_FIELDS, *_lineage("cloud"), get_profile("cloud").error_column)


def quality_errors_rules(spark, sf_dir):
    """The rule set without a timestamp rule, over the raw events."""
    v = quality_ops.validate(_lake(spark, sf_dir).events(), "rules")
    return v.groupBy("error_reason").agg(F.count(F.lit(1)).alias("n"))


def _quality_errors(profile):
    def build(spark, sf_dir):
        err = get_profile(profile).error_column
        v = _lake(spark, sf_dir).validated(profile)
        return v.groupBy(err).agg(F.count(F.lit(1)).alias("n"))
    return build


def _validated(profile):
    def build(spark, sf_dir):
        p = get_profile(profile)
        return (_lake(spark, sf_dir).validated(p)
                .select("transaction_id", f"{p.lineage_prefix}_offset", p.error_column))
    return build


def _quarantine(profile):
    def build(spark, sf_dir):
        p = get_profile(profile)
        return _lake(spark, sf_dir).quarantine(p).select(
            *EVENT_FIELDS, *_lineage(profile), p.error_column)
    return build


def _silver(profile):
    def build(spark, sf_dir):
        p = get_profile(profile)
        s = _lake(spark, sf_dir).silver(p)
        if p.parse_timestamp:
            return s.select(*_NON_TIME, *_lineage(profile), _event_epoch())
        return s.select(*EVENT_FIELDS, *_lineage(profile), p.error_column)
    return build


def approved_count(spark, sf_dir):
    s = _lake(spark, sf_dir).silver("local")
    return s.filter(F.col("status") == "APPROVED").agg(F.count(F.lit(1)).alias("approved_count"))


# -- gold --------------------------------------------------------------------
def _risk_rows(profile):
    def build(spark, sf_dir):
        p = get_profile(profile)
        r = _lake(spark, sf_dir).risk_rows(p)
        when = _event_epoch() if p.parse_timestamp else F.col("event_timestamp")
        return r.select(*_NON_TIME, *_lineage(profile), when, "risk_score", "risk_level")
    return build


def _gold(name, profile):
    def build(spark, sf_dir):
        return _lake(spark, sf_dir).gold(name, profile)
    return build


def top_merchants_local(spark, sf_dir):
    from ledgerlake.operators.gold import top
    return top(_lake(spark, sf_dir).gold("merchant", "local"), 10,
               [F.desc("total_transaction_amount"), F.asc("merchant_id"), F.asc("merchant_category")])


def _parity_silver(spark, sf_dir, p):
    """Silver by the reference's exact path: ``dropDuplicates`` (any survivor);
    the fixture's duplicates are identical events, so aggregates do not depend
    on which copy survives."""
    lake = _lake(spark, sf_dir)
    return quality_ops.shape_silver(
        quality_ops.dedup(lake.valid_before_dedup(p), ["transaction_id"]), p)


def money_of_any_amount(spark, sf_dir):
    """Totals of amounts with parts of a cent, and beyond any decimal of cents."""
    from ledgerlake.operators.gold import metrics
    k, p = F.col("o_orderkey"), F.col("o_totalprice")
    amount = (F.when(k % 3 == 0, F.floor(p * 2) / 100).when(k % 3 == 1, F.floor(p) / 1024)
              .otherwise(F.floor(p) * F.lit(float(1 << 40))))
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return metrics(orders.select((k % 3).alias("kind"), amount.cast("double").alias("amount")), ["kind"],
                   "total", "average")


def offset_runs(spark, sf_dir):
    """Runs of consecutive offsets of each topic partition, and what is missing between them."""
    return lineage.offset_runs(_lake(spark, sf_dir).topic())


def content_differences(spark, sf_dir):
    """Messages that a second copy of the topic has lost, repeated and altered (planted by offset)."""
    topic = _lake(spark, sf_dir).topic()
    planted, at = F.col("offset") < 20_000, F.col("offset") % 1000
    other = topic.where(~(planted & (at == 14))).withColumn(
        "value", F.when(planted & (at == 18), F.concat("value", F.lit(" ").cast("binary"))).otherwise(F.col("value")))
    other = other.withColumn("again", F.explode(F.when(planted & (at == 16), F.array(F.lit(0), F.lit(1)))
                                                .otherwise(F.array(F.lit(0))))).drop("again")
    return lineage.content_differences(topic, other, ["key", "value", "timestamp"])


def _stream_quality(layer):
    """A layer of the quality stream, in two runs over half of the topic each."""
    def build(spark, sf_dir):
        from ledgerlake.streaming.quality_stream import read_layer, run_quality_stream
        lake = _lake(spark, sf_dir)
        run = _fresh(lake, "quality-stream")
        for half in (0, 1):
            lake.topic().where(F.col("partition") % 2 == half).write.mode("append").parquet(f"{run}/topic")
            run_quality_stream(spark, f"{run}/topic", run)
        out = read_layer(spark, run, layer)
        if layer == "silver":       # which of two copies comes first is not fixed: without what they differ in
            return out.select(*[c for c in _NON_TIME if c != "city"], _event_epoch())
        return out.select(*EVENT_FIELDS, *_lineage("local"), "error_reason")
    return build


def _published(layer):
    """A layer of the pair that the quality job publishes together."""
    def build(spark, sf_dir):
        from ledgerlake.plans import published
        lake = _lake(spark, sf_dir)
        lake.bronze("local")
        out = published.Published(spark, _fresh(lake, "published"), "local")
        published.quality(lake.store("local"), out, "local")
        rows = out.current().read(layer, "local")
        if layer == "silver":
            return rows.select(*_NON_TIME, *_lineage("local"), _event_epoch())
        return rows.select(*EVENT_FIELDS, *_lineage("local"), "error_reason")
    return build


def incremental_daily_local(spark, sf_dir):
    """The daily metric from the partial aggregates of two loads."""
    from ledgerlake.operators import gold as gold_ops
    from ledgerlake.operators import partials
    lake = _lake(spark, sf_dir)
    rows = lake.risk_rows("local").withColumn("transaction_date", gold_ops.transaction_date("local"))
    path = _fresh(lake, "partials")
    for load in (0, 1):
        partials.add_load(rows.where(F.col("kafka_offset") % 4 >= 2 if load else F.col("kafka_offset") % 4 < 2),
                          path, load, ["transaction_date"])
    p = get_profile("local")
    return partials.merged(spark.read.parquet(path), ["transaction_date"], p.total_name, p.average_name)


def stream_daily_local(spark, sf_dir):
    """The daily metric of closed days from two runs of a stream: the second run brings later days,
    and rows of earlier days that are late by then."""
    from ledgerlake.streaming import daily_stream
    lake = _lake(spark, sf_dir)
    rows, run = lake.silver("local"), _fresh(lake, "daily-stream")
    first = (F.col("event_timestamp") < F.lit("1995-07-01").cast("timestamp")) & (F.col("kafka_offset") % 100 != 14)
    for load in (first, ~first):
        rows.where(load).write.mode("append").parquet(f"{run}/rows")
        daily_stream.run_daily_stream(spark.readStream.schema(rows.schema).parquet(f"{run}/rows"), run)
    p = get_profile("local")
    return daily_stream.closed_days(spark, run, p.total_name, p.average_name)


def _planted_payloads(topic: DataFrame) -> DataFrame:
    """The topic with payloads cut off, doubled into an array, of a wrong type, blank and missing (by offset)."""
    at, text = F.col("offset") % 1000, F.col("value").cast("string")
    bad = (F.when(at == 22, F.expr("substring(CAST(value AS STRING), 1, length(CAST(value AS STRING)) - 1)"))
           .when(at == 24, F.concat(F.lit("["), text, F.lit(","), text, F.lit("]")))
           .when(at == 26, F.regexp_replace(text, '"amount":[^,]*', '"amount":"n/a"'))
           .when(at == 28, F.lit("  ")).when(at == 30, F.lit(None).cast("string")).otherwise(text))
    return topic.withColumn("value", bad.cast("binary"))


def _quarantine_with_payloads(spark, sf_dir) -> DataFrame:
    lake = _lake(spark, sf_dir)
    store = jobs.LayerStore(spark, root=_fresh(lake, "payloads"))
    jobs.ingest(_planted_payloads(lake.topic()), store, "local", keep_raw=True)
    jobs.quality(store, "local")
    return store.read("quarantine", "local").where(F.col(bronze_ops.PAYLOAD_ERROR).isNotNull())


def malformed_payloads(spark, sf_dir):
    """Quarantined rows whose payload did not decode: their texts and what is wrong with them."""
    return _quarantine_with_payloads(spark, sf_dir).select(
        *_lineage("local"), bronze_ops.PAYLOAD_TEXT, bronze_ops.PAYLOAD_ERROR)


def replayed_payloads(spark, sf_dir):
    """Arrays, and cut-off payloads with their bracket closed, decoded again."""
    error = F.col(bronze_ops.PAYLOAD_ERROR)
    again = bronze_ops.replay_messages(
        _quarantine_with_payloads(spark, sf_dir), "order-events",
        repair=lambda text: F.when(error == "NOT_JSON", F.concat(text, F.lit("}"))).when(error == "JSON_ARRAY", text))
    return bronze_ops.bronze(again, keep_raw=True).where(error.isNull()).select(*EVENT_FIELDS, *_lineage("local"))


def exact_sums(spark, sf_dir):
    """Sums of amounts of very different sizes, with their bits: signs that cancel, parts of a cent,
    amounts that differ by 2^60."""
    from ledgerlake.functions.exact_sum import exact_sum
    k, p = F.col("l_orderkey"), F.col("l_extendedprice")
    amount = (p * (1 - F.col("l_discount")) * F.when(k % 2 == 0, 1.0).otherwise(-1.0)
              * F.when(k % 5 == 0, F.lit(float(1 << 20))).when(k % 5 == 1, F.lit(1 / 1024)).otherwise(1.0))
    return (spark.read.parquet(f"{sf_dir}/lineitem.parquet").withColumn("x", amount)
            .groupBy("l_returnflag", "l_linestatus").agg(
                F.count(F.lit(1)).alias("n"), exact_sum(F.col("x")).alias("total")))


def _parity(name, profile):
    """A metric with ``round(sum(double), 2)`` and ``round(avg(double), 2)`` over the parity silver,
    the sums taken exactly: where an average falls on half a cent, the last bit of the sum decides,
    and must not depend on the order of adding."""
    def build(spark, sf_dir):
        from ledgerlake.operators import gold as gold_ops
        p = get_profile(profile)
        return gold_ops.gold_metric(gold_ops.add_risk(_parity_silver(spark, sf_dir, p)),
                                    name, p, money_mode="exact")
    return build


def _parity_total(profile):
    """Total value with ``round(sum(double), 2)`` over the parity silver."""
    def build(spark, sf_dir):
        p = get_profile(profile)
        return monitor.total_value(_parity_silver(spark, sf_dir, p), money_mode="double")
    return build


# -- monitoring --------------------------------------------------------------
def _total_value(profile):
    def build(spark, sf_dir):
        return monitor.total_value(_lake(spark, sf_dir).silver(profile))
    return build


def _risk_distribution(profile):
    def build(spark, sf_dir):
        return monitor.risk_distribution(_lake(spark, sf_dir).risk_rows(profile))
    return build


def _duplicates_removed(profile):
    def build(spark, sf_dir):
        lake = _lake(spark, sf_dir)
        return monitor.duplicates_removed(lake.valid_before_dedup(profile), lake.silver(profile))
    return build


def _monitoring_metrics(profile):
    def build(spark, sf_dir):
        lake = _lake(spark, sf_dir)
        return monitor.monitoring_record(lake.bronze(profile), lake.silver(profile),
                                         lake.quarantine(profile), lake.risk_rows(profile))
    return build


def _metrics_document(profile):
    """The record written as a JSON document and read back."""
    def build(spark, sf_dir):
        record = _monitoring_metrics(profile)(spark, sf_dir)
        path = _fresh(_lake(spark, sf_dir), "metrics")
        sinks.write_metrics_json(record, path)
        return spark.read.schema(record.schema).json(path)
    return build


def registry() -> dict[str, Builder]:
    q: dict[str, Builder] = {
        "transactions": transactions,
        "raw_messages": raw_messages,
        "bronze_roundtrip": bronze_roundtrip,
        "bronze_stream": bronze_stream,
        "batch_stream_reconcile": batch_stream_reconcile,
        "quality_errors_rules": quality_errors_rules,
        "bronze_stream_resume": bronze_stream_resume,
        "bronze_stream_table_cloud": bronze_stream_table_cloud,
        "stream_report": stream_report,
        "events_from_json": events_from_json,
        "ingestion_stamp": ingestion_stamp,
        "silver_table_cloud": silver_table_cloud,
        "top_merchants_local": top_merchants_local,
    }
    for p in ("local", "cloud"):
        q[f"quality_errors_{p}"] = _quality_errors(p)
        q[f"validated_{p}"] = _validated(p)
        q[f"quarantine_{p}"] = _quarantine(p)
        q[f"silver_{p}"] = _silver(p)
        q[f"gold_risk_rows_{p}"] = _risk_rows(p)
        for name in ("daily", "country", "payment", "risk_summary"):
            q[f"gold_{name}_{p}"] = _gold(name, p)
        q[f"gold_merchant_{p}"] = _gold("merchant", p)
        q[f"total_value_{p}"] = _total_value(p)
        q[f"risk_distribution_{p}"] = _risk_distribution(p)
        q[f"duplicates_removed_{p}"] = _duplicates_removed(p)
        q[f"monitoring_metrics_{p}"] = _monitoring_metrics(p)
        q[f"metrics_document_{p}"] = _metrics_document(p)
        for name in ("daily", "merchant", "country", "payment", "risk_summary"):
            q[f"gold_{name}_{p}_parity"] = _parity(name, p)
        q[f"total_value_{p}_parity"] = _parity_total(p)
    q["money_of_any_amount"] = money_of_any_amount
    q["exact_sums"] = exact_sums
    q["offset_runs"] = offset_runs
    q["content_differences"] = content_differences
    for layer in ("silver", "quarantine"):
        q[f"stream_{layer}_local"] = _stream_quality(layer)
        q[f"published_{layer}_local"] = _published(layer)
    q["incremental_daily_local"] = incremental_daily_local
    q["stream_daily_local"] = stream_daily_local
    q["malformed_payloads"] = malformed_payloads
    q["replayed_payloads"] = replayed_payloads
    q["approved_count"] = approved_count
    return q
