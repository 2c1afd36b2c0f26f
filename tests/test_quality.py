"""Split, deterministic dedup, shaping, shuffle invariance, skew."""

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators.quality import dedup, quality_layers, split, validate
from ledgerlake.schema import EVENT_FIELDS
from tests.helpers import event, with_lineage


def test_split_is_exhaustive_and_disjoint(spark):
    rows = [(event(), 0, 1), (event(amount=None), 0, 2), (event(currency=None), 0, 3),
            (event(status="x"), 0, 4)]
    b = with_lineage(spark, rows)
    for prof in ("local", "cloud"):
        v = validate(b, prof)
        good, bad = split(v, prof)
        assert good.count() + bad.count() == v.count()
        assert good.join(bad, "kafka_offset").count() == 0


def test_survivor_is_earliest_message(spark):
    rows = [(event(amount=300.0), 1, 9), (event(amount=100.0), 1, 5), (event(amount=200.0), 1, 7)]
    silver, _, valid = quality_layers(with_lineage(spark, rows), "local")
    assert valid.count() == 3
    r = silver.collect()
    assert len(r) == 1 and r[0].amount == 100.0 and r[0].kafka_offset == 5


def test_invalid_copy_does_not_shadow_valid_one(spark):
    rows = [(event(amount=-1.0), 0, 1), (event(), 0, 2)]
    silver, quarantine, _ = quality_layers(with_lineage(spark, rows), "local")
    assert silver.count() == 1 and silver.first().kafka_offset == 2
    assert quarantine.count() == 1


def test_invalid_duplicates_are_all_quarantined(spark):
    rows = [(event(currency="XYZ"), 0, 1), (event(currency="XYZ"), 0, 2)]
    _, quarantine, _ = quality_layers(with_lineage(spark, rows), "local")
    assert quarantine.count() == 2


def test_silver_and_quarantine_columns(spark):
    rows = [(event(), 0, 1), (event(transaction_id="T2", amount=None), 0, 2)]
    b = with_lineage(spark, rows).withColumn("ingestion_timestamp", F.current_timestamp())
    silver, quarantine, _ = quality_layers(b, "local")
    assert silver.columns[-1] == "event_timestamp"
    assert dict(silver.dtypes)["event_timestamp"] == "timestamp"
    assert "error_reason" not in silver.columns
    assert quarantine.columns[-1] == "error_reason"
    assert dict(quarantine.dtypes)["event_timestamp"] == "string"
    csilver, cquarantine, _ = quality_layers(b.withColumnsRenamed(
        {f"kafka_{s}": f"eventhub_{s}" for s in ("partition", "offset", "timestamp")}), "cloud")
    assert csilver.columns[-1] == "validation_error"
    assert csilver.first().validation_error is None


@pytest.mark.parametrize("method", ["aggregate", "window"])
def test_dedup_methods_agree_and_survive_reshuffle(spark, lake, method):
    b = lake.bronze("local")
    order = ["kafka_timestamp", "kafka_partition", "kafka_offset"]
    ref = sorted((tuple(r) for r in dedup(b, ["transaction_id"], order, "aggregate")
                 .select(*EVENT_FIELDS, "kafka_offset").collect()), key=repr)
    shuffled = b.repartition(7, F.rand(11)).orderBy(F.col("kafka_offset").desc())
    got = sorted((tuple(r) for r in dedup(shuffled, ["transaction_id"], order, method)
                  .select(*EVENT_FIELDS, "kafka_offset").collect()), key=repr)
    assert got == ref


def test_hot_key_is_combined_map_side(spark):
    """A key holding most rows: partial aggregation ships <= 1 row per map task."""
    hot = (spark.range(0, 200_000, numPartitions=8)
           .select(F.when(F.col("id") % 3 != 0, F.lit("HOT")).otherwise(F.col("id").cast("string"))
                   .alias("transaction_id"), F.col("id").alias("kafka_offset"),
                   F.lit(0).alias("kafka_partition"), F.lit(None).cast("timestamp").alias("kafka_timestamp")))
    out = dedup(hot, ["transaction_id"], ["kafka_timestamp", "kafka_partition", "kafka_offset"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan
    r = out.filter("transaction_id = 'HOT'").first()
    assert r.kafka_offset == 1
    assert out.count() == 1 + 200_000 // 3 + (1 if 200_000 % 3 else 0)


def test_dedup_with_unorderable_payload(spark):
    df = spark.createDataFrame(
        [("A", 2, {"k": 1}), ("A", 1, {"k": 2}), ("B", 5, None)],
        "transaction_id string, kafka_offset long, props map<string,int>")
    out = {r.transaction_id: (r.kafka_offset, r.props)
           for r in dedup(df, ["transaction_id"], ["kafka_offset"]).collect()}
    assert out == {"A": (1, {"k": 2}), "B": (5, None)}


def test_survivor_precedence_across_partitions(spark):
    """Keyless sends put copies on different partitions: the earliest source
    timestamp wins, then the lower partition, then the lower offset."""
    from pyspark.sql.types import IntegerType, LongType, StructType, TimestampType
    from ledgerlake.schema import EVENT_SCHEMA
    import datetime as dt
    schema = (StructType(list(EVENT_SCHEMA.fields))
              .add("eventhub_partition", IntegerType()).add("eventhub_offset", LongType())
              .add("eventhub_timestamp", TimestampType()))
    t0 = dt.datetime(2024, 1, 1, 0, 0, 0)
    rows = [event(amount=1.0) + (0, 1, t0 + dt.timedelta(seconds=5)),   # later: loses
            event(amount=2.0) + (2, 9, t0),                              # earliest, partition 2
            event(amount=3.0) + (1, 3, t0),                              # earliest, partition 1: wins
            event(transaction_id="B", amount=4.0) + (1, 7, t0),
            event(transaction_id="B", amount=5.0) + (1, 6, t0)]          # lower offset: wins
    silver, _, _ = quality_layers(spark.createDataFrame(rows, schema), "cloud")
    got = {r.transaction_id: r.amount for r in silver.collect()}
    assert got == {"TXN-1": 3.0, "B": 5.0}


def test_dedup_with_expression_order(spark):
    df = spark.createDataFrame([("A", 5, "x"), ("A", 7, "y"), ("B", 1, "z")],
                               "transaction_id string, kafka_offset long, v string")
    latest = dedup(df, ["transaction_id"], [-F.col("kafka_offset")])   # newest wins
    assert {r.transaction_id: r.v for r in latest.collect()} == {"A": "y", "B": "z"}
