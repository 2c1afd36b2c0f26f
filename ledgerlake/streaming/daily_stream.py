"""The daily metric as a stream with a cut-off for late rows, and the late rows beside it.

A day is closed once the latest event time seen is ``delay`` past its end, judged as Spark's
watermark is: by what earlier micro-batches held.  Spark's own windowed aggregate closes the same
days with the same rows (a test holds both together) but drops a late row without a trace; here
each micro-batch tells late rows from others itself and writes

* ``partials/batch=N``: mergeable partial aggregates (:mod:`ledgerlake.operators.partials`) of the
  rows of open days, one row a day;
* ``late/batch=N``: the whole rows that came after their day was closed;
* ``marks/batch=N``: the latest event time seen until then, one row.

A micro-batch that runs again replaces its own folders and reads the mark of the one before, so
nothing is counted twice.  Rows without an event time belong to the day NULL, which never closes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerlake.operators.partials import merged, partials

DAY = "transaction_date"


def _closed(day: Column, mark: Column, delay: str) -> Column:
    """Whether a day ended ``delay`` or more before the mark (false for a NULL day or mark)."""
    return F.coalesce(F.date_add(day, 1).cast("timestamp") <= mark - F.expr(f"interval {delay}"), F.lit(False))


def run_daily_stream(rows: DataFrame, run_dir: str, time: str = "event_timestamp", amount: str = "amount",
                     delay: str = "2 days") -> StreamingQuery:
    """Run a streaming frame of silver rows over what is available; a later run goes on from its checkpoint."""
    spark = rows.sparkSession

    def write(batch: DataFrame, number: int) -> None:
        mark = spark.read.parquet(f"{run_dir}/marks/batch={number - 1}").first()["mark"] if number else None
        before = F.lit(mark).cast("timestamp")
        batch = batch.withColumn(DAY, F.to_date(time)).persist()
        try:
            late = _closed(F.col(DAY), before, delay)
            batch.where(late).write.mode("overwrite").parquet(f"{run_dir}/late/batch={number}")
            partials(batch.where(~late), [DAY], amount).write.mode("overwrite").parquet(f"{run_dir}/partials/batch={number}")
            (batch.agg(F.greatest(F.max(time), before).alias("mark"))
             .write.mode("overwrite").parquet(f"{run_dir}/marks/batch={number}"))
        finally:
            batch.unpersist()

    query = (rows.writeStream.foreachBatch(write).option("checkpointLocation", f"{run_dir}/checkpoint")
             .trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return query


def late_rows(spark: SparkSession, run_dir: str) -> DataFrame:
    """The rows that came after their day was closed."""
    return spark.read.parquet(f"{run_dir}/late").drop("batch")


def closed_days(spark: SparkSession, run_dir: str, total_name: str, average_name: str | None = None,
                delay: str = "2 days") -> DataFrame:
    """The metric of each closed day, over the rows that came in time, with the number of its ``late_rows``.
    A day of late rows only has no transactions and no total."""
    mark = spark.read.parquet(f"{run_dir}/marks").agg(F.max("mark")).first()[0]
    loads = spark.read.parquet(f"{run_dir}/partials").where(_closed(F.col(DAY), F.lit(mark).cast("timestamp"), delay))
    late = late_rows(spark, run_dir).groupBy(DAY).agg(F.count(F.lit(1)).alias("late_rows"))
    days = merged(loads, [DAY], total_name, average_name).join(late, DAY, "full_outer")
    return days.withColumns({c: F.coalesce(c, F.lit(0).cast("long")) for c in ("transaction_count", "late_rows")})
