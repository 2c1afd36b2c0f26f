"""Exact dedup as a stateful stream.

Digests of the normalised texts are streamed through a keyed state that has no
expiry and lives on disk (RocksDB): per digest the stable identifier and the
content locator of the row that stays, and the number of rows.  The state is a
streaming aggregate, so each task combines its own rows first and a digest that
holds a third of all rows reaches the state as one row per task.  Texts do not
go through the stream.  A hit (a digest with more than one row) is checked on
full bytes afterwards: the texts behind it are read again and grouped by
themselves; if one digest has several texts, those rows are classed by text.

Null text counts as empty.  Of rows with equal id and text the one with the
largest locator stays.  Extra columns pass through untouched.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import (
    FILE,
    ROW,
    ascii_lower,
    located,
    materialise,
    scratch,
    without,
)

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "64",
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "8",
    # state of an ended stream is unloaded by the next round of maintenance
    "spark.sql.streaming.stateStore.maintenanceInterval": "10s",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # else each state partition takes 4 MB of disk before it holds a row
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
SHA256 = lambda text: F.sha2(text, 256)
FILTER_BITS = 1 << 22     # 512 KB, whatever the input
PAGE = 8 * 4096           # bits that bitmap_construct_agg holds


def _stream_totals(spark: SparkSession, prints: DataFrame, path: str, state_dir: str | None,
                   files_per_trigger: int | None) -> DataFrame:
    """Rows of each digest and the row that stays, from the state after all micro-batches."""
    out = scratch(spark, "dedup-ledger")
    checkpoint = state_dir or scratch(spark, "dedup-state")

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    reader = spark.readStream.schema(prints.schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    totals = reader.parquet(path).groupBy("digest").agg(
        F.count(F.lit(1)).alias("rows"),
        F.max(F.struct("id", FILE, ROW)).alias("stays"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in totals.schema.fields)
    spark.createDataFrame([], kinds).write.parquet(f"{out}/batch=-1")     # an empty stream has no batch
    before = {k: spark.conf.get(k, None) for k in STATE_CONF}
    try:
        for k, v in STATE_CONF.items():
            spark.conf.set(k, v)
        query = (totals.writeStream.outputMode("update").foreachBatch(save)
                 .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    finally:            # the query has taken its copy of the settings
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    query.awaitTermination()
    # a digest is written anew by each micro-batch that saw it; its count only grows
    ledger = spark.read.schema(f"{kinds}, batch long").parquet(out)
    latest = ledger.groupBy("digest").agg(F.max(F.struct("rows", "stays")).alias("t"))
    return materialise(latest.select("digest", "t.rows", "t.stays"), "dedup-totals")


def _texts_of_hits(docs: DataFrame, hits: DataFrame) -> DataFrame:
    """(digest, norm) of the rows behind ``hits``, and of few others.  A bit map of a fixed size,
    kept on every executor, lets most other texts drop out before any of them is shuffled."""
    at = F.pmod(F.xxhash64("digest"), F.lit(FILTER_BITS))
    bits = (hits.select(at.alias("at"))
            .groupBy(F.expr(f"at div {PAGE}").alias("page"))
            .agg(F.bitmap_construct_agg(F.col("at") % PAGE).alias("bits")))
    near = docs.withColumn("at", at).withColumn("page", F.expr(f"at div {PAGE}")).join(
        F.broadcast(bits), "page")
    byte = F.conv(F.hex(F.expr(f"substring(bits, cast((at % {PAGE}) div 8 + 1 as int), 1)")), 16, 10).cast("int")
    is_set = F.expr("byte & (1 << cast(at % 8 as int))") != 0
    return (near.withColumn("byte", byte).where(is_set)
            .select("digest", "norm"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                normalise: Callable[[Column], Column] = ascii_lower,
                digest: Callable[[Column], Column] = SHA256,
                state_dir: str | None = None, files_per_trigger: int | None = None) -> DataFrame:
    """One row per row of ``docs``: id, ``keep_id``, ``group_size``, ``kept``, ``digest``
    and the row's locator (file and row).

    ``state_dir``: a checkpoint to go on from in later calls; then rows are
    classed with those of earlier calls by digest alone, and bytes are compared
    within the call only: a departure from the rule that hits are decided by bytes.  By default each call has its own, and one micro-batch takes all
    files.  The state has ``spark.sql.shuffle.partitions`` partitions, fixed by
    the first call.
    """
    spark = docs.sparkSession
    rows = located(docs)
    norm = normalise(F.coalesce(F.col(text_col), F.lit("")))
    rows = rows.select(F.col(id_col).alias("id"), FILE, ROW, norm.alias("norm")).withColumn(
        "digest", digest(F.col("norm")))
    path = scratch(spark, "dedup-prints")
    rows.drop("norm").write.parquet(path)
    prints = spark.read.schema(rows.drop("norm").schema).parquet(path)
    totals = _stream_totals(spark, prints, path, state_dir, files_per_trigger)

    hits = totals.where("rows > 1").select("digest")
    # full bytes: rows of one digest are one class only if they are one text (each task
    # counts its own copies first, so a hot text is shuffled once per task)
    classes = _texts_of_hits(rows, hits).groupBy("digest", "norm").count()
    clashes = materialise(classes.groupBy("digest").agg(F.count(F.lit(1)).alias("texts"))
                          .where("texts > 1").select("digest"), "dedup-clashes")
    answer = prints.join(totals, "digest", "left")
    if not clashes.isEmpty():
        clashed = rows.join(clashes, "digest", "left_semi")
        by_text = materialise(clashed.groupBy("digest", "norm").agg(
            F.count(F.lit(1)).alias("rows"), F.max(F.struct("id", FILE, ROW)).alias("stays")),
            "dedup-classes")
        answer = answer.join(clashes, "digest", "left_anti").unionByName(
            clashed.join(by_text, ["digest", "norm"], "left").drop("norm"))
    own = F.struct("id", FILE, ROW)
    return answer.select(F.col("id").alias(id_col), F.col("stays.id").alias("keep_id"),
                         F.col("rows").alias("group_size"), own.eqNullSafe(F.col("stays")).alias("kept"),
                         "digest", FILE, ROW)


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose text another row keeps."""
    rows = located(docs)
    dropped = exact_dedup(rows, id_col, text_col).where("not kept").select(FILE, ROW)
    return without(rows, materialise(dropped, "dedup-dropped"))
