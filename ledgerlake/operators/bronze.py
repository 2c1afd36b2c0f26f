"""Envelope encode / decode: events <-> Kafka-shaped messages -> bronze.

``bronze`` is one narrow projection (cast, ``from_json``, struct expansion,
lineage renames, ingestion stamp).  It works unchanged on a batch frame and on
a streaming frame, so the bounded and the incremental ingest produce the same
rows (except the ingestion stamp, which is per query / per micro-batch).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerlake.schema import EVENT_FIELDS, EVENT_SCHEMA

PAYLOAD = "transaction"
# with ``keep_raw``: the text of a malformed payload and what is wrong with it (null for a sound one)
PAYLOAD_TEXT, PAYLOAD_ERROR = "payload_text", "payload_error"


def encode_messages(events: DataFrame, topic: str, key: str | None = "transaction_id",
                    partition: str | None = "partition", offset: str | None = "offset",
                    timestamp: str | None = None, fields: list[str] | None = None) -> DataFrame:
    """Events -> Kafka source schema (``key, value, topic, partition, offset,
    timestamp, timestampType``).

    The value is the JSON object of the event fields with NULL fields kept
    (``ignoreNullFields=false``), as a Python ``json.dumps`` producer writes
    them.  Without ``key`` the message is keyless (the Event Hubs producer).
    ``partition`` / ``offset`` / ``timestamp`` name columns of ``events``
    when the position on the log is known (replays, tests); otherwise they
    are NULL, as for a frame about to be published.
    """
    fields = fields or EVENT_FIELDS
    value = F.to_json(F.struct(*[F.col(f) for f in fields]), {"ignoreNullFields": "false"})

    def _or_null(name, dtype):
        return F.col(name).cast(dtype) if name else F.lit(None).cast(dtype)

    return events.select(
        (F.col(key).cast("binary") if key else F.lit(None).cast("binary")).alias("key"),
        value.cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        _or_null(partition, "int").alias("partition"),
        _or_null(offset, "bigint").alias("offset"),
        _or_null(timestamp, "timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def bronze(messages: DataFrame, schema: StructType = EVENT_SCHEMA, prefix: str = "kafka",
           stamp: bool = True, keep_raw: bool = False) -> DataFrame:
    """Kafka-shaped messages -> bronze rows.

    Columns: the schema's fields, ``<prefix>_partition``, ``<prefix>_offset``,
    ``<prefix>_timestamp`` and (when ``stamp``) ``ingestion_timestamp``.
    ``from_json`` is PERMISSIVE: malformed JSON yields a row of NULLs, which
    the quality rules then quarantine -- ingest never fails on a bad message.
    With ``keep_raw`` such a row carries its text in ``payload_text`` and its
    kind in ``payload_error`` (:func:`payload_error`); a field of a wrong type
    is NULL, the other fields of its object are kept.
    """
    lineage = [F.col(c).alias(f"{prefix}_{c}") for c in ("partition", "offset", "timestamp")]
    names = [c.format(prefix) for c in ("{}_partition", "{}_offset", "{}_timestamp")]
    text = F.col("value").cast("string")
    if keep_raw:
        corrupt = "_corrupt"
        while corrupt in schema.names:
            corrupt += "_"
        wide = StructType([*schema.fields, StructField(corrupt, StringType())])
        parsed = F.from_json(text, wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt})
        out = messages.select(parsed.alias(PAYLOAD), text.alias(PAYLOAD_TEXT), *lineage)
        bad = F.col(PAYLOAD).isNull() | F.col(f"{PAYLOAD}.{corrupt}").isNotNull()
        kind = F.when(bad, payload_error(F.col(PAYLOAD_TEXT)))
        out = out.select(*[F.col(f"{PAYLOAD}.{f}").alias(f) for f in schema.names], *names,
                         F.when(bad, F.col(PAYLOAD_TEXT)).alias(PAYLOAD_TEXT), kind.alias(PAYLOAD_ERROR))
    else:
        out = (messages.select(F.from_json(text, schema).alias(PAYLOAD), *lineage)
               .select(f"{PAYLOAD}.*", *names))
    if stamp:
        out = out.withColumn("ingestion_timestamp", F.current_timestamp())
    return out


def payload_error(text: Column) -> Column:
    """What a payload that did not decode is: ``NO_PAYLOAD`` (null), ``EMPTY_PAYLOAD``, ``NOT_JSON``
    (cut off, or no JSON at all), ``JSON_ARRAY``, ``JSON_SCALAR``, or ``WRONG_TYPE``: an object with
    a field that is not of its type."""
    kind = F.schema_of_variant(F.try_parse_json(text))
    return (F.when(text.isNull(), "NO_PAYLOAD").when(F.trim(text) == "", "EMPTY_PAYLOAD")
            .when(kind.isNull(), "NOT_JSON").when(kind.startswith("ARRAY"), "JSON_ARRAY")
            .when(kind.startswith("OBJECT"), "WRONG_TYPE").otherwise("JSON_SCALAR"))


def replay_messages(quarantine: DataFrame, topic: str, prefix: str = "kafka",
                    repair: Callable[[Column], Column] | None = None) -> DataFrame:
    """Quarantined payloads as messages again, at their old places on the log, for :func:`bronze`
    to decode once more.  ``repair`` maps the text (null: leave this one out); it may use
    ``payload_error`` and the lineage columns.  An array that is left gives a message an element."""
    text = F.col(PAYLOAD_TEXT)
    bad = quarantine.where(text.isNotNull()).withColumn(PAYLOAD_TEXT, repair(text) if repair else text)
    elements = F.when(F.trim(text).startswith("["), F.from_json(text, "array<string>"))
    # (an array that does not parse is one message, as any other text)
    values = F.when(elements.isNotNull(), elements).otherwise(F.array(text))
    return bad.where(text.isNotNull()).withColumn("_value", F.explode(values)).select(
        F.lit(None).cast("binary").alias("key"), F.col("_value").cast("binary").alias("value"),
        F.lit(topic).alias("topic"), *[F.col(f"{prefix}_{c}").alias(c) for c in ("partition", "offset", "timestamp")],
        F.lit(0).alias("timestampType"))


def raw_messages(messages: DataFrame) -> DataFrame:
    """Key and value as text plus the log position (the console preview)."""
    return messages.selectExpr(
        "CAST(key AS STRING) AS kafka_key",
        "CAST(value AS STRING) AS kafka_value",
        "topic", "partition", "offset", "timestamp",
    )
