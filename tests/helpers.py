from pyspark.sql.types import IntegerType, LongType, StructType

from ledgerlake.schema import EVENT_FIELDS, EVENT_SCHEMA

VALID = {
    "transaction_id": "TXN-1", "customer_id": "CUST-1", "account_id": "ACC-1",
    "merchant_id": "MER-1", "merchant_category": "BOOKS", "transaction_type": "SALE",
    "amount": 100.0, "currency": "USD", "payment_method": "CARD", "country": "US",
    "city": "CITY", "device_type": "WEB", "status": "APPROVED",
    "event_timestamp": "2024-01-01T10:00:00+00:00",
}


def event(**overrides):
    row = dict(VALID)
    row.update(overrides)
    return tuple(row[f] for f in EVENT_FIELDS)


def events_df(spark, *rows):
    return spark.createDataFrame(list(rows), EVENT_SCHEMA)


def with_lineage(spark, rows, prefix="kafka"):
    """rows: (event_tuple, partition, offset) -> bronze-shaped frame."""
    from pyspark.sql import functions as F
    data = [ev + (p, o) for ev, p, o in rows]
    schema = (StructType(list(EVENT_SCHEMA.fields))  # .add mutates: copy first
              .add(f"{prefix}_partition", IntegerType()).add(f"{prefix}_offset", LongType()))
    return (spark.createDataFrame(data, schema)
            .withColumn(f"{prefix}_timestamp", F.lit("2024-01-01 00:00:00").cast("timestamp")))
