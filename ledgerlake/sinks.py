"""Batch sinks and table DDL.

Streaming sinks live in :mod:`ledgerlake.streaming.ingest`.  Formats are a
parameter: ``parquet`` works everywhere; ``delta`` needs the Delta Lake
package on the classpath.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.operators.bronze import encode_messages


def holds_stream(spark: SparkSession, path: str) -> bool:
    """Whether a stream writes to ``path``: its log of committed files lies there."""
    log = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_spark_metadata")
    return bool(log.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(log))


def write_layer(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None, options: dict[str, str] | None = None) -> None:
    """Overwrite a layer at ``path`` (one file per task; no driver collect).

    Refuses a folder that a stream writes to, before anything is deleted: the
    stream's checkpoint would go on naming files that are gone."""
    if mode == "overwrite" and holds_stream(df.sparkSession, path):
        raise ValueError(f"{path} is the sink of a stream: choose another folder or layout, or remove it "
                         "together with the stream's checkpoint")
    writer = df.write.format(fmt).mode(mode).options(**(options or {}))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_table(df: DataFrame, name: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None) -> None:
    """Overwrite a catalog table."""
    df.write.format(fmt).mode(mode).saveAsTable(name, partitionBy=partition_by)


def create_schema(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}")


def write_metrics_json(metrics: DataFrame, path: str) -> None:
    """The one-row monitoring record as a JSON document (same keys)."""
    metrics.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def publish_frame(events: DataFrame, topic: str | None = None,
                  key: str | None = "transaction_id") -> DataFrame:
    """The rows a Kafka write sends: ``key`` (NULL when keyless), ``value`` =
    JSON of the event with NULL fields kept, and ``topic`` when given."""
    msgs = encode_messages(events, topic or "", key=key, partition=None, offset=None)
    return msgs.select("key", "value", "topic") if topic else msgs.select("key", "value")


def publish_options(options: dict[str, str], topic: str | None = None) -> dict[str, str]:
    """Writer options from a source option map: producer reliability defaults
    ``acks=all`` and three retries (overridable), reader-only keys dropped."""
    opts = {"kafka.acks": "all", "kafka.retries": "3"}
    opts.update({k: v for k, v in options.items()
                 if k not in ("subscribe", "startingOffsets", "endingOffsets",
                              "maxOffsetsPerTrigger", "minPartitions")})
    if topic:
        opts["topic"] = topic
    return opts


def publish(events: DataFrame, options: dict[str, str], topic: str | None = None,
            key: str | None = "transaction_id") -> None:
    """Publish events to a Kafka topic (or Event Hubs' Kafka endpoint): one
    distributed write, each task producing its own partition's messages."""
    topic = topic or options.get("subscribe")
    (publish_frame(events, None, key).write.format("kafka")
     .options(**publish_options(options, topic)).save())
