"""Message-log sources: Kafka / Event Hubs (Kafka endpoint) and a file stand-in.

The connector is addressed through ``format("kafka")``; it needs the
``spark-sql-kafka`` package on the cluster classpath.  For offline runs the
same Kafka-shaped rows are read from Parquet with the fixed Kafka schema,
through ``read`` (bounded) or ``readStream`` (incremental) -- everything
downstream is identical.

One Spark task reads one topic partition; ``min_partitions`` lets the source
split large partitions across more tasks.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.schema import KAFKA_SCHEMA

# ---------------------------------------------------------------------------
# Event Hubs Kafka endpoint conventions
# ---------------------------------------------------------------------------
EVENTHUBS_PORT = 9093
EVENTHUBS_DOMAIN = "servicebus.windows.net"
EVENTHUBS_USER = "$ConnectionString"
PLAIN_LOGIN_MODULE = "org.apache.kafka.common.security.plain.PlainLoginModule"
# ---------------------------------------------------------------------------


def kafka_options(bootstrap: str, topic: str, starting: str = "earliest",
                  ending: str | None = None, min_partitions: int | None = None,
                  max_offsets_per_trigger: int | None = None,
                  **extra: str) -> dict[str, str]:
    """Options for one subscribed topic. ``ending`` only applies to batch reads.

    ``max_offsets_per_trigger`` bounds a micro-batch (an ``availableNow`` run
    over a large backlog then proceeds in several bounded batches instead of
    one huge one); ``min_partitions`` splits large topic partitions over more
    tasks.
    """
    opts = {"kafka.bootstrap.servers": bootstrap, "subscribe": topic,
            "startingOffsets": starting}
    if ending is not None:
        opts["endingOffsets"] = ending
    if min_partitions:
        opts["minPartitions"] = str(min_partitions)
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    opts.update(extra)
    return opts


def jaas_config(connection_string: str, login_module_prefix: str = "") -> str:
    """SASL PLAIN JAAS line for an Event Hubs connection string.

    ``login_module_prefix`` is for platforms that ship a relocated
    ("shaded") Kafka client; plain Spark needs none.
    """
    return (f"{login_module_prefix}{PLAIN_LOGIN_MODULE} required "
            f'username="{EVENTHUBS_USER}" password="{connection_string}";')


def eventhubs_options(namespace: str, hub: str, connection_string: str,
                      starting: str = "earliest", ending: str | None = None,
                      login_module_prefix: str = "", **extra: str) -> dict[str, str]:
    """Kafka options for an Event Hubs namespace over SASL_SSL / PLAIN.

    The returned map holds the secret: pass it to the reader, never log it.
    """
    return kafka_options(
        f"{namespace}.{EVENTHUBS_DOMAIN}:{EVENTHUBS_PORT}", hub, starting, ending,
        **{"kafka.security.protocol": "SASL_SSL",
           "kafka.sasl.mechanism": "PLAIN",
           "kafka.sasl.jaas.config": jaas_config(connection_string, login_module_prefix)},
        **extra)


def secret_from_env(name: str) -> str:
    """Read a secret from the environment; fail loudly, never echo it."""
    value = os.environ.get(name)
    if not value:
        raise KeyError(f"secret {name!r} is not set in the environment")
    return value


def redact(options: dict[str, str]) -> dict[str, str]:
    """A copy safe to print: the JAAS line (which embeds the secret) masked."""
    return {k: ("***" if "jaas" in k or "password" in k else v) for k, v in options.items()}


def read_kafka(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Bounded read (``startingOffsets`` .. ``endingOffsets``)."""
    opts = {k: v for k, v in options.items() if k != "maxOffsetsPerTrigger"}
    opts.setdefault("endingOffsets", "latest")
    return spark.read.format("kafka").options(**opts).load()


def read_kafka_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Unbounded read; progress is tracked in the query's checkpoint."""
    opts = {k: v for k, v in options.items() if k != "endingOffsets"}
    return spark.readStream.format("kafka").options(**opts).load()


def read_message_files(spark: SparkSession, path: str) -> DataFrame:
    """Kafka-shaped Parquet as a bounded source (offline stand-in)."""
    return spark.read.schema(KAFKA_SCHEMA).parquet(path)


def read_message_files_stream(spark: SparkSession, path: str,
                              max_files_per_trigger: int | None = None,
                              max_bytes_per_trigger: int | None = None) -> DataFrame:
    """Kafka-shaped Parquet as an incremental source (offline stand-in).

    New files appearing under ``path`` are the new messages; the file source
    records which files it has processed in the query checkpoint.  A bound on
    the bytes of a micro-batch keeps it as wide as the cluster; a bound on the
    files may not.
    """
    reader = spark.readStream.schema(KAFKA_SCHEMA)
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", str(max_bytes_per_trigger))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(path)
