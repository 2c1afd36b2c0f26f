"""Quality as a stream: one pass over new messages, two sinks, dedup with bounded state.

Bronze rows are validated as in the batch job.  Valid rows are deduplicated by
transaction id within a watermark on the message time: the state keeps an id
until the watermark has passed it, so its size is that of the ids of the
watermark's span.  A copy within it is dropped also if it comes in another
micro-batch or run; one that comes later is kept, and a row older than the
watermark is late: neither sink gets it, and :func:`left_out` finds it.  Invalid
rows are kept one by one.

Each micro-batch writes its quarantine and its silver rows to folders of its
own number.  A micro-batch that failed between the two writes runs again with
the same rows and replaces its own folders, so neither sink has rows twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerlake.functions.rules import Profile, get_profile, is_valid
from ledgerlake.operators import quality
from ledgerlake.operators.bronze import bronze
from ledgerlake.schema import EVENT_SCHEMA, KAFKA_SCHEMA
from ledgerlake.streaming.ingest import bronze_stream_from_files

KEY = "_dedup_key"


def deduplicated(validated: DataFrame, profile: str | Profile = "local", delay: str = "10 minutes") -> DataFrame:
    """Valid rows one per transaction id within the watermark; every invalid row (by its log position)."""
    p = get_profile(profile)
    pre = p.lineage_prefix
    position = F.concat(F.lit("at:"), F.col(f"{pre}_partition").cast("string"), F.lit(":"), F.col(f"{pre}_offset").cast("string"))
    key = F.when(is_valid(p), F.concat(F.lit("id:"), F.col("transaction_id"))).otherwise(position)
    return (validated.withColumn(KEY, key).withWatermark(f"{pre}_timestamp", delay)
            .dropDuplicatesWithinWatermark([KEY]).drop(KEY))


def run_quality_stream(spark: SparkSession, source_path: str, run_dir: str, profile: str | Profile = "local",
                       delay: str = "10 minutes", max_files_per_trigger: int | None = None,
                       between: Callable[[int], None] | None = None) -> StreamingQuery:
    """Run over what is available: ``run_dir``/quarantine and ``run_dir``/silver, a folder a micro-batch.
    Going on from its checkpoint, a later run takes new messages only.  ``between`` is called after the
    first of a micro-batch's two writes (for tests)."""
    p = get_profile(profile)
    rows = quality.validate(bronze_stream_from_files(spark, source_path, p.lineage_prefix, max_files_per_trigger), p)

    def write(batch: DataFrame, number: int) -> None:
        batch.persist()             # two writes of one micro-batch; recomputed where an executor is lost
        try:
            valid, invalid = quality.split(batch, p)
            quality.shape_quarantine(invalid, p).write.mode("overwrite").parquet(f"{run_dir}/quarantine/batch={number}")
            if between:
                between(number)
            quality.shape_silver(valid, p).write.mode("overwrite").parquet(f"{run_dir}/silver/batch={number}")
        finally:
            batch.unpersist()

    query = (deduplicated(rows, p, delay).writeStream.foreachBatch(write).outputMode("append")
             .option("checkpointLocation", f"{run_dir}/checkpoint").trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return query


def left_out(spark: SparkSession, source_path: str, run_dir: str, profile: str | Profile = "local") -> DataFrame:
    """The validated rows of the source that neither layer stands for: valid ones whose transaction id
    silver does not hold, invalid ones that quarantine does not hold (by log position).  After a run
    these are the rows that came behind the watermark.  Both checks are joins by key, so a row of the source
    is in silver, a copy of one there, in quarantine, or here."""
    p = get_profile(profile)
    pre = p.lineage_prefix
    rows = quality.validate(bronze(spark.read.schema(KAFKA_SCHEMA).parquet(source_path), EVENT_SCHEMA, pre), p)
    valid, invalid = quality.split(rows, p)

    def unseen(mine: DataFrame, layer: str, keys: list[str]) -> DataFrame:
        seen = read_layer(spark, run_dir, layer).select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct()
        on = [mine[k].eqNullSafe(seen[f"_{k}"]) for k in keys]
        return mine.join(seen, on, "left_anti")

    return unseen(valid, "silver", ["transaction_id"]).unionByName(
        unseen(invalid, "quarantine", [f"{pre}_partition", f"{pre}_offset"]))


def read_layer(spark: SparkSession, run_dir: str, layer: str) -> DataFrame:
    """All micro-batches of ``silver`` or ``quarantine``."""
    return spark.read.parquet(f"{run_dir}/{layer}").drop("batch")
