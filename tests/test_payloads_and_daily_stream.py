"""Texts of malformed payloads and their replay; the daily stream with its late rows."""

import datetime as dt
import json

from pyspark.sql import functions as F

from ledgerlake.functions.rules import get_profile
from ledgerlake.operators import bronze as ops
from ledgerlake.operators import quality
from ledgerlake.operators.partials import merged, partials
from ledgerlake.schema import EVENT_FIELDS, KAFKA_SCHEMA
from ledgerlake.streaming import daily_stream
from tests.helpers import VALID

SOUND = json.dumps(VALID)
TEXTS = [SOUND, SOUND[:-9], f"[{SOUND}, {SOUND}]", json.dumps({**VALID, "amount": "n/a"}), "", "  ", None,
         "null", "7", '"text"', "not json", "[]", "{}", "[1, 2", json.dumps({**VALID, "amount": None})]
KINDS = [None, "NOT_JSON", "JSON_ARRAY", "WRONG_TYPE", "EMPTY_PAYLOAD", "EMPTY_PAYLOAD", "NO_PAYLOAD",
         "JSON_SCALAR", "JSON_SCALAR", "JSON_SCALAR", "NOT_JSON", "JSON_ARRAY", None, "NOT_JSON", None]


def messages(spark, texts):
    when = dt.datetime(2024, 1, 1)
    return spark.createDataFrame([(None, None if t is None else bytearray(t.encode()), "t", 0, i, when, 0)
                                  for i, t in enumerate(texts)], KAFKA_SCHEMA)


def test_kinds_of_malformed_payloads(spark):
    rows = ops.bronze(messages(spark, TEXTS), keep_raw=True).orderBy("kafka_offset").collect()
    assert [r.payload_error for r in rows] == KINDS
    assert [r.payload_text for r in rows] == [t if k else None for t, k in zip(TEXTS, KINDS, strict=True)]
    assert rows[3].transaction_id == "TXN-1" and rows[3].amount is None      # the sound fields are kept


def test_other_columns_are_those_without_texts(spark):
    plain = ops.bronze(messages(spark, TEXTS), stamp=False)
    kept = ops.bronze(messages(spark, TEXTS), stamp=False, keep_raw=True)
    assert kept.columns == [*plain.columns, ops.PAYLOAD_TEXT, ops.PAYLOAD_ERROR]
    assert sorted(map(repr, kept.select(*plain.columns).collect())) == sorted(map(repr, plain.collect()))


def test_a_schema_with_the_name_of_the_inner_column(spark):
    from pyspark.sql.types import StringType, StructField, StructType
    schema = StructType([StructField("_corrupt", StringType()), StructField("a", StringType())])
    rows = ops.bronze(messages(spark, ['{"_corrupt": "x", "a": "y"}', "{"]), schema, keep_raw=True).orderBy("kafka_offset").collect()
    assert [(r["_corrupt"], r.a, r.payload_error) for r in rows] == [("x", "y", None), (None, None, "NOT_JSON")]


def test_texts_go_to_quarantine_and_not_to_silver(spark):
    for name in ("local", "cloud"):
        p = get_profile(name)
        rows = ops.bronze(messages(spark, TEXTS), prefix=p.lineage_prefix, keep_raw=True)
        silver, quarantine, _ = quality.quality_layers(rows, p)
        plain = quality.quality_layers(ops.bronze(messages(spark, TEXTS), prefix=p.lineage_prefix), p)
        assert silver.columns == plain[0].columns and silver.count() == plain[0].count() == 1
        assert set(quarantine.columns) - set(plain[1].columns) == {ops.PAYLOAD_TEXT, ops.PAYLOAD_ERROR}
        assert quarantine.count() == plain[1].count() == len(TEXTS) - 1


def test_replay(spark):
    bad = quality.quarantine(ops.bronze(messages(spark, TEXTS), keep_raw=True))
    again = ops.bronze(ops.replay_messages(bad, "t"), keep_raw=True)
    got = sorted((r.kafka_offset, r.transaction_id, r.payload_error) for r in again.collect())
    # an array gives its elements (an empty one none); other texts are what they were; null payloads have no text
    same = [(i, "TXN-1" if k == "WRONG_TYPE" else None, k) for i, k in enumerate(KINDS) if k and k not in ("JSON_ARRAY", "NO_PAYLOAD")]
    assert sorted(got, key=repr) == sorted(same + [(2, "TXN-1", None)] * 2, key=repr)
    mended = ops.bronze(ops.replay_messages(
        bad, "t", repair=lambda text: F.when(F.col(ops.PAYLOAD_ERROR) == "NOT_JSON", F.concat(text, F.lit('00:00"}')))))
    assert [tuple(r[f] for f in EVENT_FIELDS)[:1] for r in mended.where("kafka_offset = 1").collect()] == [("TXN-1",)]
    assert ops.replay_messages(bad.where("false"), "t").count() == 0


SCHEMA = "event_timestamp timestamp, amount double, n int"


def _load(spark, run, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{run}/rows")


def _day(d, hour=0):
    return dt.datetime(2024, 1, d, hour)


LOADS = [[(_day(1), 1.0, 1), (_day(1, 23), 0.1, 2), (_day(2), 0.2, 3), (_day(5), 5.0, 4)],
         [(_day(2, 12), 9.0, 5), (_day(3), 3.5, 6), (_day(4, 1), 4.0, 7), (None, 1.0, 8), (_day(3, 2), None, 9)],
         [(_day(3, 3), 7.0, 10), (_day(9), 2.0, 11), (_day(4), 6.0, 12)]]


def _run(spark, run):
    return daily_stream.run_daily_stream(spark.readStream.schema(SCHEMA).parquet(f"{run}/rows"), run, delay="1 day")


def _closed(spark, run):
    return sorted(tuple(r) for r in daily_stream.closed_days(spark, run, "total", "average", delay="1 day").collect())


def test_late_rows_are_kept_beside_the_closed_days(spark, tmp_path):
    run = str(tmp_path)
    for load in LOADS:
        _load(spark, run, load)
        _run(spark, run)
    # the mark is day 5 after the first load: days 1 to 3 end a day or more before it
    assert sorted(r.n for r in daily_stream.late_rows(spark, run).collect()) == [5, 6, 9, 10]
    d = [dt.date(2023, 12, 31) + dt.timedelta(i) for i in range(10)]
    assert sorted(_closed(spark, run), key=repr) == sorted(
        [(d[1], 2, 1.1, 0.55, 0), (d[2], 1, 0.2, 0.2, 1), (d[3], 0, None, None, 3), (d[4], 2, 10.0, 5.0, 0), (d[5], 1, 5.0, 5.0, 0)],
        key=repr)
    before = _closed(spark, run)
    _run(spark, run)                                    # nothing new: nothing changes
    assert _closed(spark, run) == before


def test_a_micro_batch_that_runs_again_counts_once(spark, tmp_path, monkeypatch):
    run = str(tmp_path)
    _load(spark, run, LOADS[0])
    _run(spark, run)
    _load(spark, run, LOADS[1])
    failing = daily_stream.partials

    def fail(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(daily_stream, "partials", fail)     # after the late rows are written
    try:
        _run(spark, run)
        raise AssertionError("the run should have failed")
    except Exception as error:
        assert "lost" in str(error)
    monkeypatch.setattr(daily_stream, "partials", failing)
    _run(spark, run)
    assert sorted(r.n for r in daily_stream.late_rows(spark, run).collect()) == [5, 6, 9]
    assert sum(r.transaction_count for r in daily_stream.closed_days(spark, run, "t", delay="1 day").collect()) == 3


def test_closed_days_are_those_of_sparks_watermark(spark, tmp_path):
    run = str(tmp_path)
    for load in LOADS:
        _load(spark, run, load)
        _run(spark, run)
        stream = (spark.readStream.schema(SCHEMA).parquet(f"{run}/rows").withWatermark("event_timestamp", "1 day")
                  .groupBy(F.window("event_timestamp", "1 day").alias("w"))
                  .agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("s")))
        query = (stream.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
                 .option("checkpointLocation", f"{run}/native-checkpoint").start(f"{run}/native"))
        query.awaitTermination()
    native = sorted((r.w.start.date(), r.n) for r in spark.read.parquet(f"{run}/native").collect())
    assert native == [x[:2] for x in _closed(spark, run) if x[1]]
    late = daily_stream.late_rows(spark, run).count()
    rows = sum(map(len, LOADS)) - 1                      # (one row has no time)
    open_rows = spark.read.parquet(f"{run}/rows").where("event_timestamp >= '2024-01-06'").count()
    assert late == rows - sum(n for _, n in native) - open_rows


def test_partials_are_the_shared_ones(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), 0.1)] * 3, f"{daily_stream.DAY} date, amount double")
    assert merged(partials(df, [daily_stream.DAY]), [daily_stream.DAY], "t").first()["t"] == 0.3
