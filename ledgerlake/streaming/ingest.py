"""Incremental ingest: message log -> bronze, as a checkpointed stream.

``bronze`` is the same stateless projection as the batch path; the stream
adds only the source, the sink and the checkpoint.  ``availableNow`` processes
everything present at start (in as many micro-batches as the source's rate
limit asks for) and stops, so a scheduled job gets exactly-once incremental
loads: a re-run with no new input writes nothing, a re-run after new files
appends only them.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ledgerlake.operators.bronze import bronze, raw_messages
from ledgerlake.schema import EVENT_SCHEMA
from ledgerlake.sources.kafka import read_kafka_stream, read_message_files_stream


def start_stream(df: DataFrame, checkpoint: str, path: str | None = None,
                 table: str | None = None, fmt: str = "parquet",
                 available_now: bool = True, processing_time: str | None = None,
                 query_name: str | None = None) -> StreamingQuery:
    """Append ``df`` to a path or a catalog table with a checkpoint."""
    writer = (df.writeStream.format(fmt).outputMode("append")
              .option("checkpointLocation", checkpoint))
    if query_name:
        writer = writer.queryName(query_name)
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    elif available_now:
        writer = writer.trigger(availableNow=True)
    if table:
        return writer.toTable(table)
    if path is None:
        raise ValueError("a stream sink needs a path or a table")
    return writer.start(path)


def bronze_stream_from_files(spark: SparkSession, source_path: str, prefix: str = "kafka",
                             max_files_per_trigger: int | None = None,
                             max_bytes_per_trigger: int | None = None, keep_raw: bool = False) -> DataFrame:
    return bronze(read_message_files_stream(spark, source_path, max_files_per_trigger, max_bytes_per_trigger),
                  EVENT_SCHEMA, prefix, keep_raw=keep_raw)


def bronze_stream_from_kafka(spark: SparkSession, options: dict[str, str],
                             prefix: str = "kafka") -> DataFrame:
    return bronze(read_kafka_stream(spark, options), EVENT_SCHEMA, prefix)


def run_bronze_stream(spark: SparkSession, source_path: str, run_dir: str,
                      prefix: str = "kafka", max_files_per_trigger: int | None = None,
                      fmt: str = "parquet", table: str | None = None
                      ) -> tuple[str, StreamingQuery]:
    """Run the file-backed ingest to completion; returns (sink path, query).

    ``run_dir`` holds ``bronze/`` (the sink) and ``checkpoint/``.  Calling it
    again resumes from the checkpoint and appends only unseen input.
    """
    sink, checkpoint = f"{run_dir}/bronze", f"{run_dir}/checkpoint"
    stream = bronze_stream_from_files(spark, source_path, prefix, max_files_per_trigger)
    query = start_stream(stream, checkpoint, path=None if table else sink, table=table, fmt=fmt)
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return sink, query


def console_preview(messages: DataFrame, fmt: str = "console",
                    query_name: str | None = None) -> StreamingQuery:
    """Raw key / value preview of a stream (``console`` untruncated, or
    ``memory`` for tests); runs over what is available, then stops."""
    writer = (raw_messages(messages).writeStream.format(fmt).outputMode("append")
              .option("truncate", "false").trigger(availableNow=True))
    if query_name:
        writer = writer.queryName(query_name)
    return writer.start()


class BatchTotals(StreamingQueryListener):
    """Running totals over every micro-batch of the queries started while it listens."""

    def __init__(self):
        self.micro_batches = self.input_rows = self.trigger_ms = 0
        self.ended = threading.Event()

    def onQueryStarted(self, event):  # noqa: N802
        pass

    def onQueryProgress(self, event):  # noqa: N802
        self.micro_batches += 1
        self.input_rows += event.progress.numInputRows
        self.trigger_ms += dict(event.progress.durationMs).get("triggerExecution", 0)

    def onQueryIdle(self, event):  # noqa: N802
        pass

    def onQueryTerminated(self, event):  # noqa: N802
        self.ended.set()


def run_with_totals(spark: SparkSession, start: Callable[[], StreamingQuery],
                    patience_s: float = 60) -> tuple[StreamingQuery, dict[str, int]]:
    """Run the query that ``start`` starts to its end; its totals over all micro-batches.

    They come from the query's events, which Spark delivers in order: the end
    comes after every progress.  (A query's own list of progress keeps the last
    ``spark.sql.streaming.numRecentProgressUpdates`` only.)  Run one at a time
    per session.
    """
    totals = BatchTotals()
    spark.streams.addListener(totals)
    try:
        query = start()
        query.awaitTermination()
        if not totals.ended.wait(patience_s):
            raise TimeoutError("the end of the query was not reported")
    finally:
        spark.streams.removeListener(totals)
    return query, {"micro_batches": totals.micro_batches, "input_rows": totals.input_rows,
                   "trigger_ms": totals.trigger_ms}


def progress_report(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """Throughput of a finished query's last micro-batches (rows, rows/s, duration).

    The progress list is query metadata, not data, and holds the last
    ``spark.sql.streaming.numRecentProgressUpdates`` entries: totals come from
    :func:`run_with_totals`.
    """
    rows = [(int(p["batchId"]), int(p["numInputRows"]),
             float(p.get("inputRowsPerSecond") or 0.0),
             float(p.get("processedRowsPerSecond") or 0.0),
             int((p.get("durationMs") or {}).get("triggerExecution", 0)))
            for p in query.recentProgress]
    return spark.createDataFrame(
        rows, "batch_id long, num_input_rows long, input_rows_per_second double, "
              "processed_rows_per_second double, trigger_ms long")
