"""Connector option maps, JSON-array input, batch sinks, the full batch run."""

import json
import os

import pytest

from ledgerlake.plans.jobs import LayerStore, run_batch
from ledgerlake.sources import kafka
from ledgerlake.sources.files import from_rows, read_event_json
from ledgerlake.schema import EVENT_FIELDS
from tests.helpers import VALID


def test_eventhubs_options_and_redaction():
    opts = kafka.eventhubs_options("ns1", "hub1", "Endpoint=sb://x;SharedAccessKey=SECRET")
    assert opts["kafka.bootstrap.servers"] == "ns1.servicebus.windows.net:9093"
    assert opts["subscribe"] == "hub1" and opts["startingOffsets"] == "earliest"
    assert opts["kafka.security.protocol"] == "SASL_SSL"
    assert opts["kafka.sasl.mechanism"] == "PLAIN"
    jaas = opts["kafka.sasl.jaas.config"]
    assert jaas.startswith("org.apache.kafka.common.security.plain.PlainLoginModule required")
    assert 'username="$ConnectionString"' in jaas and "SECRET" in jaas
    assert "SECRET" not in json.dumps(kafka.redact(opts))
    shaded = kafka.jaas_config("c", login_module_prefix="shaded.")
    assert shaded.startswith("shaded.org.apache.kafka")


def test_kafka_options_batch_and_stream():
    opts = kafka.kafka_options("host:9092", "t", ending="latest", min_partitions=12)
    assert opts["endingOffsets"] == "latest" and opts["minPartitions"] == "12"


def test_secret_from_env(monkeypatch):
    monkeypatch.setenv("LL_TEST_SECRET", "abc")
    assert kafka.secret_from_env("LL_TEST_SECRET") == "abc"
    with pytest.raises(KeyError):
        kafka.secret_from_env("LL_TEST_MISSING")


def test_kafka_format_is_addressed(spark):
    """The connector is not on this classpath; the reader must still be built
    from the option map and fail only at resolution."""
    with pytest.raises(Exception) as err:
        kafka.read_kafka(spark, kafka.kafka_options("localhost:1", "t")).schema
    assert "kafka" in str(err.value).lower()


def test_json_array_file(spark, tmp_path):
    path = tmp_path / "transactions.json"
    rows = [dict(VALID, transaction_id=f"TXN-{i}") for i in range(3)]
    path.write_text(json.dumps(rows, indent=4))
    df = read_event_json(spark, str(path))
    assert df.count() == 3 and df.columns == EVENT_FIELDS


def test_rows_with_ddl_schema(spark):
    df = from_rows(spark, [("T", None, 1.0)], "transaction_id STRING, customer_id STRING, amount DOUBLE")
    assert df.first().customer_id is None


def test_run_batch_to_paths(spark, lake, tmp_path):
    store = LayerStore(spark, root=str(tmp_path / "lake"))
    rec = run_batch(spark, lake.topic(), store, "local", metrics_path=str(tmp_path / "metrics"))
    assert rec["bronze_records"] == 1516 and rec["silver_records"] == 1417
    assert rec["quarantined_records"] == 83
    assert rec["records_removed_during_quality_processing"] == 16
    # metric groups: 1054 days + 1417 merchants + 5 countries + 4 methods + 3 levels
    assert rec["observed_counts"] == {"bronze_records": 1516, "quarantined_records": 83,
                                      "silver_records": 1417, "valid_before_dedup": 1433,
                                      "duplicates_removed": 16, "gold_risk_records": 1417,
                                      "gold_metric_groups": 2483}
    assert rec["status"] == "SUCCESS" and rec["generated_at_utc"]
    for name in ("bronze", "silver", "quarantine", "gold/risk_scored_transactions",
                 "gold/daily_transaction_metrics", "gold/merchant_transaction_metrics",
                 "gold/country_transaction_metrics", "gold/payment_method_metrics",
                 "gold/risk_summary"):
        assert os.path.isdir(tmp_path / "lake" / name), name
    doc = spark.read.json(str(tmp_path / "metrics")).first().asDict()
    assert doc["silver_retention_rate_percent"] == rec["silver_retention_rate_percent"]


def test_run_batch_to_tables(spark, lake):
    store = LayerStore(spark, schema="lakehouse_cloud")
    rec = run_batch(spark, lake.topic(), store, "cloud")
    assert (rec["bronze_records"], rec["silver_records"], rec["quarantined_records"]) == (
        1516, 1411, 89)
    assert spark.table("lakehouse_cloud.gold_risk_summary").count() == 3
    assert "validation_error" in spark.table("lakehouse_cloud.silver_transactions").columns
    assert spark.table("lakehouse_cloud.gold_risk_scored_transactions").count() == 1411
    local_tables = LayerStore(spark, schema="lakehouse_cloud", layout="local")
    assert local_tables.location("risk_rows") == "lakehouse_cloud.gold_risk_scored_transactions"
    assert local_tables.location("bronze") == "lakehouse_cloud.bronze"


def test_rate_limit_option_is_stream_only(spark):
    opts = kafka.kafka_options("h:1", "t", max_offsets_per_trigger=1000)
    assert opts["maxOffsetsPerTrigger"] == "1000"


def test_size_shuffles_from_input(spark, lake):
    from ledgerlake.session import input_bytes, size_shuffles
    lake.bronze("local")
    path = lake.store("local").location("bronze", "local")
    assert input_bytes(spark, [path]) > 0
    n = size_shuffles(spark, [path], target_bytes=1024)
    assert n >= spark.sparkContext.defaultParallelism
    assert spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum") == str(n)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")


def test_publish_frame_and_options(spark):
    from ledgerlake.sinks import publish_frame, publish_options
    from tests.helpers import event, events_df
    df = events_df(spark, event(customer_id=None), event(transaction_id="T2"))
    rows = publish_frame(df).collect()
    assert [bytes(r.key).decode() for r in rows] == ["TXN-1", "T2"]
    assert '"customer_id":null' in bytes(rows[0].value).decode()
    assert publish_frame(df, key=None).first().key is None
    assert publish_frame(df, topic="t").columns == ["key", "value", "topic"]
    opts = publish_options(kafka.eventhubs_options("ns", "hub", "s"), "hub")
    assert opts["kafka.acks"] == "all" and opts["kafka.retries"] == "3"
    assert opts["topic"] == "hub" and "subscribe" not in opts
    assert opts["kafka.security.protocol"] == "SASL_SSL"


def test_sized_shuffles_is_scoped_and_respects_user_setting(spark, lake):
    from ledgerlake.session import INITIAL_PARTITIONS, sized_shuffles
    path = lake.store("local").location("bronze", "local")
    lake.bronze("local")
    with sized_shuffles(spark, [path], target_bytes=1024) as n:
        assert spark.conf.get(INITIAL_PARTITIONS) == str(n)
    assert spark.conf.get(INITIAL_PARTITIONS, None) is None
    spark.conf.set(INITIAL_PARTITIONS, "7")
    with sized_shuffles(spark, [path], target_bytes=1024) as n:
        assert n == 7
    assert spark.conf.get(INITIAL_PARTITIONS) == "7"
    spark.conf.unset(INITIAL_PARTITIONS)


def test_run_batch_with_another_format(spark, lake, tmp_path):
    """The layer format is a parameter (ORC here; Delta / Iceberg the same way)."""
    store = LayerStore(spark, root=str(tmp_path / "orc"), fmt="orc")
    rec = run_batch(spark, lake.topic(), store, "cloud")
    assert (rec["bronze_records"], rec["silver_records"]) == (1516, 1411)
    assert list((tmp_path / "orc" / "silver_transactions").glob("*.orc"))


def test_json_lines_events(spark, tmp_path):
    path = tmp_path / "events.jsonl"
    path.write_text("\n".join(json.dumps(dict(VALID, transaction_id=f"T{i}")) for i in range(5)))
    df = read_event_json(spark, str(path), multiline=False)
    assert df.count() == 5 and df.columns == EVENT_FIELDS


def test_empty_topic_through_every_job(spark, tmp_path):
    from ledgerlake.schema import KAFKA_SCHEMA
    empty = spark.createDataFrame([], KAFKA_SCHEMA)
    rec = run_batch(spark, empty, LayerStore(spark, root=str(tmp_path / "lake")), "local",
                    metrics_path=str(tmp_path / "m"))
    assert rec["bronze_records"] == rec["silver_records"] == rec["gold_risk_records"] == 0
    assert rec["silver_retention_rate_percent"] is None
    assert rec["generated_at_utc"].endswith("+00:00")


def test_partition_sizing_never_fails(spark):
    from ledgerlake.session import partitions_for
    n = partitions_for(spark, ["/nonexistent/ledgerlake/path"])
    assert n == spark.sparkContext.defaultParallelism
