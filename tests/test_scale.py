"""Sizing, stream totals, sinks that must not clash, and positions of produced messages."""

import json

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators.bronze import encode_messages
from ledgerlake.plans.jobs import LayerStore, ingest, quality
from ledgerlake.session import (
    ADVISORY_BYTES,
    INITIAL_PARTITIONS,
    MOST_PARTITIONS,
    SPLIT_BYTES,
    plan_bytes,
    reducers_for,
    sized_session,
    sorting_session,
)
from ledgerlake.sources.kafka import read_message_files
from ledgerlake.streaming.ingest import bronze_stream_from_files, run_with_totals, start_stream
from tests.helpers import VALID, event, events_df


def _messages(spark, path, ids):
    rows = events_df(spark, *[event(transaction_id=f"T{i}") for i in ids]).withColumns({
        "partition": F.lit(0), "offset": F.monotonically_increasing_id() + ids[0], "ts": F.current_timestamp()})
    encode_messages(rows, "t", timestamp="ts").coalesce(1).write.mode("append").parquet(path)


def test_reducers_grow_with_the_input_up_to_a_bound():
    assert reducers_for(0, 8) == 8
    assert reducers_for(10 << 30, 8) == 320
    assert reducers_for(100 << 40, 8) == MOST_PARTITIONS


def test_paths_and_tables_get_the_same_number(spark, lake):
    paths = LayerStore(spark, root=lake.path("sizing"))
    tables = LayerStore(spark, schema="sizing")
    number = []
    for store in (paths, tables):
        ingest(lake.topic(), store)
        own = sized_session(spark, store.read("bronze"), target_bytes=4096)
        number.append(int(own.conf.get(INITIAL_PARTITIONS)))
    assert number[0] == number[1] > spark.sparkContext.defaultParallelism


def test_overlapping_jobs_keep_their_own_number(spark, lake):
    df = lake.bronze("local")
    a = sized_session(spark, df, target_bytes=1024)
    b = sized_session(spark, df, target_bytes=8192)
    assert a.conf.get(INITIAL_PARTITIONS) != b.conf.get(INITIAL_PARTITIONS)
    assert spark.conf.get(INITIAL_PARTITIONS, None) is None
    assert a.conf.get("spark.sql.session.timeZone") == "UTC" and plan_bytes(df) > 0
    spark.conf.set(INITIAL_PARTITIONS, "7")
    try:
        assert sized_session(spark, df).conf.get(INITIAL_PARTITIONS) == "7"
    finally:
        spark.conf.unset(INITIAL_PARTITIONS)


def test_tasks_that_sort_whole_rows_are_bounded_on_both_sides_of_the_shuffle(spark, lake):
    df = lake.bronze("local")
    own = sorting_session(spark, df, target_bytes=64 << 10)
    assert int(own.conf.get(INITIAL_PARTITIONS)) == max(spark.sparkContext.defaultParallelism, -(-plan_bytes(df) // 2048))
    assert (own.conf.get(SPLIT_BYTES), own.conf.get(ADVISORY_BYTES)) == ("4096", "8192")
    spark.conf.set(SPLIT_BYTES, "1234567")
    try:
        own = sorting_session(spark, df)
        assert (own.conf.get(SPLIT_BYTES), own.conf.get(ADVISORY_BYTES)) == ("1234567", str(16 << 20))
    finally:
        spark.conf.unset(SPLIT_BYTES)
    assert spark.conf.get(ADVISORY_BYTES) != "8192"


def test_bronze_is_read_by_row_groups_of_a_bounded_size(spark, lake, tmp_path, monkeypatch):
    import pyarrow.dataset as ds

    from ledgerlake.plans import jobs
    monkeypatch.setattr(jobs, "SMALL_ROW_GROUPS", {"parquet.block.size": "20000"})
    store = LayerStore(spark, root=str(tmp_path))
    ingest(lake.topic().coalesce(1), store)
    pieces = [f.metadata.num_row_groups for f in ds.dataset(store.location("bronze")).get_fragments()]
    assert max(pieces) > 1
    counts = quality(store)
    assert counts["silver_records"] == lake.silver("local").count()


def test_orders_are_spread_before_they_become_events(lake):
    spread = lake.encoded_messages(5)
    plan = spread._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("RepartitionByExpression"):]
    assert "o_orderkey" in below.split("\n")[0] and "to_json" not in below and "MER-" not in below
    assert "o_orderpriority" not in below.split("Relation")[0]
    assert spread.rdd.getNumPartitions() == 5
    assert spread.exceptAll(lake.encoded_messages()).isEmpty() and lake.encoded_messages().exceptAll(spread).isEmpty()


def test_unknown_layout_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError, match="unknown layout"):
        LayerStore(spark, root=str(tmp_path), layout="typo").location("bronze")


def test_totals_cover_batches_that_spark_forgets(spark, tmp_path):
    src, key = str(tmp_path / "topic"), "spark.sql.streaming.numRecentProgressUpdates"
    for i in range(10):
        _messages(spark, src, [3 * i, 3 * i + 1, 3 * i + 2])
    spark.conf.set(key, "3")
    try:
        query, totals = run_with_totals(spark, lambda: start_stream(
            bronze_stream_from_files(spark, src, max_files_per_trigger=1), str(tmp_path / "c"), str(tmp_path / "b")))
    finally:
        spark.conf.unset(key)
    assert len(query.recentProgress) <= 3
    assert (totals["micro_batches"], totals["input_rows"]) == (10, 30)


def test_a_batch_write_refuses_the_folder_of_a_stream(spark, tmp_path):
    src, store = str(tmp_path / "topic"), LayerStore(spark, root=str(tmp_path / "lake"))

    def stream():
        start_stream(bronze_stream_from_files(spark, src), str(tmp_path / "c"), store.location("stream_bronze")).awaitTermination()

    _messages(spark, src, [0, 1, 2])
    stream()
    with pytest.raises(ValueError, match="sink of a stream"):
        ingest(read_message_files(spark, src), store)
    _messages(spark, src, [3, 4])
    stream()
    rows = [r.transaction_id for r in store.read("bronze").collect()]
    assert sorted(rows) == ["T0", "T1", "T2", "T3", "T4"]
    assert quality(store)["silver_records"] == 5


def test_gold_splits_read_one_folder(spark, lake):
    plan = lake.gold_all("local").where("metric = 'country'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(metric" in plan and "metric" in plan


def test_produced_messages_have_positions(spark, tmp_path, capsys):
    from ledgerlake.cli import main
    topic = str(tmp_path / "topic")
    for run in range(2):
        src = tmp_path / f"events{run}.json"
        src.write_text(json.dumps([dict(VALID, transaction_id=f"T{i}", city=f"run {run}") for i in range(6)]))
        assert main(["produce", "--events", str(src), "--topic-dir", topic, "--partitions", "4"]) == 0
    rows = read_message_files(spark, topic).collect()
    assert len({r.offset for r in rows}) == 12 and {r.partition for r in rows} <= set(range(4))
    where = {}
    for r in rows:
        assert where.setdefault(bytes(r.key), r.partition) == r.partition      # a key stays in its partition
    first = [r.offset for r in rows if b"run 0" in bytes(r.value)]
    assert max(first) < min(r.offset for r in rows if b"run 1" in bytes(r.value))


def test_rates_reach_the_reader():
    from ledgerlake.cli import _broker_options, parser
    args = parser().parse_args(["ingest", "--bootstrap", "h:1", "--topic", "t", "--min-partitions", "64",
                                "--max-offsets-per-trigger", "1000"])
    options = _broker_options(args)
    assert options["minPartitions"] == "64" and options["maxOffsetsPerTrigger"] == "1000"
