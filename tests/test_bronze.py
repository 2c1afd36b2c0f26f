"""Envelope encode / decode and malformed payloads."""

from pyspark.sql import functions as F

from ledgerlake.operators.bronze import bronze, encode_messages, raw_messages
from ledgerlake.schema import EVENT_FIELDS, KAFKA_SCHEMA
from tests.helpers import event, events_df


def _messages(spark, payloads):
    rows = [(None, None if p is None else bytearray(p.encode()), "t", 0, i, None, 0)
            for i, p in enumerate(payloads)]
    return spark.createDataFrame(rows, KAFKA_SCHEMA)


def test_roundtrip_keeps_every_field(spark):
    src = events_df(spark, event(), event(transaction_id="TXN-2", customer_id=None,
                                          amount=-3.5, currency=" usd ", event_timestamp=None))
    src = src.withColumn("partition", F.lit(1)).withColumn("offset", F.monotonically_increasing_id())
    msgs = encode_messages(src, "topic-a")
    assert msgs.schema.fieldNames() == KAFKA_SCHEMA.fieldNames()
    out = bronze(msgs, prefix="kafka")
    assert out.columns == EVENT_FIELDS + ["kafka_partition", "kafka_offset", "kafka_timestamp",
                                          "ingestion_timestamp"]
    got = sorted(tuple(r) for r in out.select(*EVENT_FIELDS).collect())
    want = sorted(tuple(r) for r in src.select(*EVENT_FIELDS).collect())
    assert got == want


def test_null_fields_are_kept_in_json(spark):
    msgs = encode_messages(events_df(spark, event(customer_id=None)), "t",
                           partition=None, offset=None)
    value = raw_messages(msgs).first().kafka_value
    assert '"customer_id":null' in value
    assert raw_messages(msgs).first().kafka_key == "TXN-1"


def test_keyless_messages(spark):
    msgs = encode_messages(events_df(spark, event()), "t", key=None, partition=None, offset=None)
    assert msgs.first().key is None


def test_malformed_payloads_become_null_rows(spark):
    payloads = ["not json", '{"transaction_id": "T1", "amount": 1', "", None, '[1, 2]',
                '{"transaction_id": "T2", "amount": "12.5"}',
                '{"transaction_id": "T3", "amount": 5, "extra": 1}',
                '{"transaction_id": "T4", "amount": NaN}',
                '{"transaction_id": 42}']
    out = bronze(_messages(spark, payloads), stamp=False).orderBy("kafka_offset").collect()
    assert len(out) == len(payloads)
    for r in out[:5]:
        assert all(r[f] is None for f in EVENT_FIELDS)
    assert (out[5].transaction_id, out[5].amount) == ("T2", None)
    assert (out[6].transaction_id, out[6].amount) == ("T3", 5.0)
    assert out[7].amount != out[7].amount  # NaN
    assert out[8].transaction_id == "42"


def test_malformed_payload_is_quarantined_not_raised(spark):
    from ledgerlake.operators.quality import quarantine
    b = bronze(_messages(spark, ["{{{"]))
    r = quarantine(b, "local").first()
    assert r.error_reason == ("MISSING_TRANSACTION_ID; MISSING_CUSTOMER_ID; MISSING_AMOUNT; "
                              "INVALID_OR_MISSING_TIMESTAMP")
    assert quarantine(b, "cloud").first().validation_error == "MISSING_TRANSACTION_ID"


def test_prefix_names_lineage(spark):
    out = bronze(_messages(spark, ["{}"]), prefix="eventhub")
    assert {"eventhub_partition", "eventhub_offset", "eventhub_timestamp"} <= set(out.columns)
