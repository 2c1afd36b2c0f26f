"""Schemas and fixed vocabularies of the transaction event model."""

from __future__ import annotations

from pyspark.sql.types import (
    BinaryType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for identical results)
# ---------------------------------------------------------------------------
EVENT_FIELDS = [
    "transaction_id", "customer_id", "account_id", "merchant_id",
    "merchant_category", "transaction_type", "amount", "currency",
    "payment_method", "country", "city", "device_type", "status",
    "event_timestamp",
]
VALID_CURRENCIES = ["USD", "EUR", "GBP", "CAD"]
VALID_STATUSES = ["APPROVED", "DECLINED", "PENDING"]
HOME_COUNTRY = "US"
HIGH_AMOUNT = 5000
RISK_LEVELS = ["HIGH", "MEDIUM", "LOW"]
# ---------------------------------------------------------------------------

# Every field is a nullable string except the amount.
EVENT_SCHEMA = StructType([
    StructField(name, DoubleType() if name == "amount" else StringType(), True)
    for name in EVENT_FIELDS
])

# Spark's Kafka source schema (the envelope every message arrives in).
KAFKA_SCHEMA = StructType([
    StructField("key", BinaryType(), True),
    StructField("value", BinaryType(), True),
    StructField("topic", StringType(), True),
    StructField("partition", IntegerType(), True),
    StructField("offset", LongType(), True),
    StructField("timestamp", TimestampType(), True),
    StructField("timestampType", IntegerType(), True),
])
