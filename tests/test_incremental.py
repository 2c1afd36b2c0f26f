"""Incremental lakehouse: runs of offsets, content differences, partials, the quality stream, published pairs."""

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import lineage, partials
from ledgerlake.operators.bronze import encode_messages
from ledgerlake.plans import jobs, published
from ledgerlake.plans.jobs import LayerStore
from ledgerlake.streaming.quality_stream import left_out, read_layer, run_quality_stream
from tests.helpers import event, events_df


def plain_runs(rows):
    seen = defaultdict(Counter)
    for p, o in rows:
        if p is not None and o is not None:
            seen[p][o] += 1
    out = []
    for p, counts in seen.items():
        own = sorted(counts)
        starts = [i for i, o in enumerate(own) if i == 0 or own[i - 1] != o - 1]
        for a, b in zip(starts, [*starts[1:], len(own)], strict=True):
            rows_of = sum(counts[o] for o in own[a:b])
            out.append((p, own[a], own[b - 1], rows_of, rows_of - (b - a), own[b] - own[b - 1] - 1 if b < len(own) else None))
    return sorted(out)


@pytest.mark.parametrize("size", [4, 16, 1 << 16])
def test_offset_runs(spark, size):
    r = random.Random(size)
    rows = [(0, o) for o in range(100) if o not in (7, 8, 31, 32, 33, 64)] + [(1, o) for o in r.sample(range(200), 90)]
    rows += [(2, o) for o in range(3, 60)] + [(3, 1000)] + [(0, 5)] * 3 + [(None, 1), (1, None)]
    r.shuffle(rows)
    got = lineage.offset_runs(spark.createDataFrame(rows, "partition int, offset long"), size=size)
    assert got.columns == ["partition", "first_offset", "last_offset", "rows", "repeats", "missing"]
    assert sorted(tuple(x) for x in got.collect()) == plain_runs(rows)


def test_content_differences(spark):
    rows = [(o % 3, o, f"k{o}", f"v{o}" if o % 7 else None) for o in range(300)]
    other = [x for x in rows if x[1] != 50] + [rows[60], (1, 999, "new", "x")]
    other[10] = (*other[10][:3], "changed")
    # what one loses another repeats: equal counts in a range
    a, b = (spark.createDataFrame(x, "partition int, offset long, key string, value string") for x in (rows, other))
    got = lineage.content_differences(a, b, ["key", "value"], size=64).collect()
    assert sorted(tuple(x) for x in got) == sorted([
        (50 % 3, 50, "lost", 1, 0), (0, 60, "repeated", 1, 2), (1, 999, "added", 0, 1), (10 % 3, 10, "altered", 1, 1)])
    assert lineage.content_differences(a, a.repartition(5), ["key", "value"]).count() == 0
    assert lineage.content_differences(a.where("false"), a.where("false"), ["key"]).count() == 0


def test_partials_merge_to_the_metric_and_a_load_replaces_itself(spark, tmp_path):
    r = random.Random(3)
    rows = [(i % 3, r.choice([0.1, 1 / 3, -7.25, 1e12, None]), i) for i in range(500)] + [(9, float("nan"), 1), (8, 1e22, 1), (7, None, 1)]
    df = spark.createDataFrame(rows, "k int, amount double, i int")
    for load in (0, 1, 1):
        partials.add_load(df.where(F.col("i") % 2 == load), str(tmp_path / "p"), load, ["k"])
    got = {x["k"]: x for x in partials.merged(spark.read.parquet(str(tmp_path / "p")), ["k"], "t", "a").collect()}
    for k in {x[0] for x in rows}:
        own = [x[1] for x in rows if x[0] == k and x[1] is not None]
        assert got[k]["transaction_count"] == sum(x[0] == k for x in rows)
        if not own:
            assert got[k]["t"] is None and got[k]["a"] is None
        elif math.isnan(own[0]):
            assert math.isnan(got[k]["t"])
        else:
            assert got[k]["t"] == pytest.approx(math.fsum(own), abs=0.006) and got[k]["a"] == pytest.approx(math.fsum(own) / len(own), abs=0.006)


def messages(spark, path, rows, offset0):
    """(id, seconds, currency) as one topic file."""
    ev = events_df(spark, *[event(transaction_id=i, currency=c) for i, _, c in rows]).coalesce(1)
    times = F.element_at(F.array(*[F.lit(s) for _, s, _ in rows]), (F.col("offset") - offset0 + 1).cast("int"))
    ev = ev.withColumn("partition", F.lit(0)).withColumn("offset", F.monotonically_increasing_id() + offset0)
    encode_messages(ev.withColumn("ts", F.timestamp_seconds(times)), "t", timestamp="ts").write.mode("append").parquet(path)


def test_quality_stream_drops_copies_across_batches_and_keeps_those_beyond_the_watermark(spark, tmp_path):
    src, run = str(tmp_path / "topic"), str(tmp_path / "run")
    start = 1_700_000_000
    messages(spark, src, [("a", start, "USD"), ("b", start + 5, "USD"), ("b", start + 6, "USD"), ("x", start, "???"), ("x", start, "???")], 0)
    run_quality_stream(spark, src, run)
    messages(spark, src, [("a", start + 60, "USD"), ("c", start + 61, "USD"), ("y", start + 61, "???")], 100)
    run_quality_stream(spark, src, run)                       # the copy of a is in another run
    ids = sorted(x[0] for x in read_layer(spark, run, "silver").select("transaction_id").collect())
    assert ids == ["a", "b", "c"]
    assert sorted(x[0] for x in read_layer(spark, run, "quarantine").select("transaction_id").collect()) == ["x", "x", "y"]
    messages(spark, src, [("d", start + 7200, "USD")], 200)   # moves the watermark on
    run_quality_stream(spark, src, run)
    messages(spark, src, [("a", start + 7300, "USD"), ("late", start, "USD")], 300)
    run_quality_stream(spark, src, run)                       # a is forgotten by now; a row before the watermark is late
    ids = sorted(x[0] for x in read_layer(spark, run, "silver").select("transaction_id").collect())
    assert ids == ["a", "a", "b", "c", "d"]


def test_a_batch_that_failed_between_its_sinks_replaces_its_rows(spark, tmp_path):
    src, run = str(tmp_path / "topic"), str(tmp_path / "run")
    messages(spark, src, [("a", 1_700_000_000, "USD"), ("a", 1_700_000_001, "USD"), ("x", 1_700_000_000, "???")], 0)

    def fail(number):
        raise RuntimeError("between the sinks")

    with pytest.raises(Exception, match="between the sinks"):
        run_quality_stream(spark, src, run, between=fail)
    assert read_layer(spark, run, "quarantine").count() == 1
    run_quality_stream(spark, src, run)
    run_quality_stream(spark, src, run)
    assert read_layer(spark, run, "quarantine").count() == 1 and read_layer(spark, run, "silver").count() == 1


def test_silver_and_quarantine_appear_together(spark, tmp_path, monkeypatch):
    store = LayerStore(spark, root=str(tmp_path / "lake"), layout="local")
    out = published.Published(spark, str(tmp_path / "out"), "local")
    with pytest.raises(FileNotFoundError):
        out.current()

    def load(n):
        src = str(tmp_path / f"topic{n}")
        messages(spark, src, [(f"id{i}", 1_700_000_000, "USD" if i % 3 else "???") for i in range(n)], 0)
        jobs.ingest(spark.read.parquet(src), store, "local")

    load(6)
    counts = published.quality(store, out)
    first = out.current()
    assert (first.read("silver").count(), first.read("quarantine").count()) == (4, 2)
    assert counts["silver_records"] == 4
    load(9)
    write = LayerStore.write

    def half(self, df, layer, *a, **kw):
        if layer == "silver":
            raise OSError("disk")
        return write(self, df, layer, *a, **kw)

    monkeypatch.setattr(LayerStore, "write", half)
    with pytest.raises(OSError):
        published.quality(store, out)
    monkeypatch.undo()
    now = out.current()
    assert now.root == first.root and (now.read("silver").count(), now.read("quarantine").count()) == (4, 2)
    published.quality(store, out)
    now = out.current()
    assert (now.read("silver").count(), now.read("quarantine").count()) == (6, 3)
    assert first.read("silver").count() == 4          # who has resolved the earlier run goes on with it


def test_every_row_is_in_a_layer_or_a_copy_or_left_out(spark, tmp_path):
    src, run = str(tmp_path / "topic"), str(tmp_path / "run")
    start = 1_700_000_000
    messages(spark, src, [("a", start, "USD"), ("a", start + 1, "USD"), ("x", start, "???")], 0)
    run_quality_stream(spark, src, run)
    assert left_out(spark, src, run).count() == 0
    messages(spark, src, [("d", start + 7200, "USD")], 100)        # moves the watermark on
    run_quality_stream(spark, src, run)
    messages(spark, src, [("late", start, "USD"), ("a", start, "USD"), ("x", start, "???"), ("e", start + 7300, "USD")], 200)
    run_quality_stream(spark, src, run)
    got = left_out(spark, src, run).select("transaction_id", "kafka_offset").collect()
    assert sorted(map(tuple, got)) == [("late", 200), ("x", 202)]   # the late copy of a has a in silver
    assert sorted(x[0] for x in read_layer(spark, run, "silver").select("transaction_id").collect()) == ["a", "d", "e"]
