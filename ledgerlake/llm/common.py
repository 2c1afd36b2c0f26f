"""What several operators share: sizing, shared tables, row locators, worker state."""

from __future__ import annotations

import ctypes
import gc
import sys
import types
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.session import shared_dir

FILE, ROW = "_loc_file", "_loc_row"
# In the metadata of columns: a locator is told by it, not by its name; the name that a column had.
IS_LOCATOR, OWN_NAME = "ledgerlake.locator", "ledgerlake.own_name"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Logical plans that give at most one row for each row they read.
ROW_BY_ROW = {"Project", "Filter", "SubqueryAlias", "View", "ResolvedHint"}
PAGE_BITS = 8 * 4096      # bits that bitmap_construct_agg holds
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def prepare(spark: SparkSession, batch_bytes: int = 8 << 20) -> SparkSession:
    """Bound the Arrow batches that Python tasks get, by bytes: texts differ in length."""
    spark.conf.set(BATCH_BYTES, str(batch_bytes))
    return spark


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the cluster's shared folder."""
    return f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, and what
    is read twice is computed once.  Survives the loss of any executor."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path, partitionBy=partition_by)
    return spark.read.schema(df.schema).parquet(path)


def plan_bytes(df: DataFrame) -> int:
    """The optimizer's estimate of the bytes of ``df``: file sizes, no job."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def pieces_for(df: DataFrame, piece_bytes: int = 32 << 20, most: int = 100_000) -> int:
    """How many partitions a shuffle of ``df`` needs: in proportion to its bytes,
    at least the session's setting.  Beyond ``most`` the pieces grow instead."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, min(most, -(-plan_bytes(df) // piece_bytes)))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, UPPER, LOWER)


def bare_scan(df: DataFrame) -> bool:
    """Whether each row of ``df`` is a row of one table, the same whenever it is read: a scan with
    projections and filters only.  No job."""
    plan = df._jdf.queryExecution().analyzed()
    if not plan.deterministic():
        return False
    while (name := plan.getClass().getSimpleName()) in ROW_BY_ROW:
        plan = plan.children().apply(0)
    return name == "LogicalRelation"


def located(docs: DataFrame) -> DataFrame:
    """``docs`` with the locator of each row: its file and its row there.

    The pair is unique and does not change when a task runs again, so it tells
    repeated rows apart.  Rows that are not read from Parquet files, and rows of
    any plan that is more than a scan with projections and filters (``explode``
    gives many rows for one, a union may read a file twice), are written to the
    shared folder first.  Rows that have locators keep them.  A column of the documents with a
    locator's name has another one meanwhile: ``carried`` gives it back.
    """
    if any(f.name == FILE and f.metadata.get(IS_LOCATOR) for f in docs.schema.fields):
        return docs
    where = [F.col(f"_metadata.{c}").alias(name, metadata={IS_LOCATOR: True})
             for c, name in (("file_path", FILE), ("row_index", ROW))]
    columns = [F.col(f"`{c}`") if c.lower() not in (FILE, ROW) else
               F.col(f"`{c}`").alias(fresh([*docs.columns, FILE, ROW], c), metadata={OWN_NAME: c}) for c in docs.columns]
    if bare_scan(docs):
        try:
            return docs.select(*columns, *where)
        except AnalysisException:
            pass
    return materialise(docs, "located").select(*columns, *where)


def carried(docs: DataFrame) -> list[Column]:
    """The columns of ``located`` documents but the locators, by their own names."""
    rest = [f for f in docs.schema.fields if not f.metadata.get(IS_LOCATOR)]
    return [F.col(f"`{f.name}`").alias(f.metadata[OWN_NAME], metadata={}) if OWN_NAME in f.metadata
            else F.col(f"`{f.name}`") for f in rest]


def without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """The rows of ``located`` documents that ``dropped`` does not list, with the columns of the documents.

    The list is sent as bit maps, one of 4 KB for each 32,768 rows of a file with a dropped row: a bit a
    row.  Spark broadcasts them if their files are below its threshold (10 MB hold 80 million rows), so
    texts are not shuffled; beyond it the maps meet the rows of their part of the file by a join.
    """
    file, page, bits = (fresh(docs.columns, x) for x in ("file", "page", "bits"))
    maps = materialise(
        dropped.groupBy(F.col(FILE).alias(file), F.expr(f"{ROW} div {PAGE_BITS}").alias(page))
        .agg(F.bitmap_construct_agg(F.col(ROW) % PAGE_BITS).alias(bits)), "dropped-bits")
    on = [docs[FILE] == maps[file], F.expr(f"{ROW} div {PAGE_BITS}") == maps[page]]
    byte = F.conv(F.hex(F.expr(f"substring({bits}, cast(({ROW} % {PAGE_BITS}) div 8 + 1 as int), 1)")), 16, 10).cast("int")
    is_set = F.coalesce(byte.bitwiseAND(F.expr(f"1 << cast({ROW} % 8 as int)")) != 0, F.lit(False))
    return docs.join(maps, on, "left").where(~is_set).select(*carried(docs))


def numbered(df: DataFrame, order: list[str], name: str) -> tuple[DataFrame, int]:
    """``df`` with ``row_number`` (0 to rows - 1, gapless) in the order of the
    columns ``order`` (nulls first), and the number of rows.

    Range-sorted rows are written once, with their position in their file part;
    the parts' counts then give each part's start.  Ties take the order of the
    input's partitions, which also splits a repeated key over several ranges.
    Only one row per part goes through the one task that adds up the counts.
    """
    from pyspark.sql import Window

    n = pieces_for(df)
    tie, at, part = (fresh(df.columns, x) for x in ("tie", "at", "part"))
    ranged = (df.withColumn(tie, F.monotonically_increasing_id())
              .repartitionByRange(n, *order, tie)
              .sortWithinPartitions(*order, tie)
              .drop(tie).withColumn(at, F.monotonically_increasing_id()))
    rows = materialise(ranged, name).withColumns({
        part: F.shiftrightunsigned(at, 33),
        at: F.col(at).bitwiseAND(F.lit((1 << 33) - 1))})
    counts = rows.select(F.col(part).alias("of")).groupBy("of").agg(F.count(F.lit(1)).alias("rows"))
    counts = materialise(counts, name + "-parts")
    total = counts.agg(F.sum("rows")).first()[0] or 0
    before = Window.orderBy("of").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("of", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    # one row per part: pieces_for bounds it
    out = (rows.alias("r").join(F.broadcast(starts.alias("s")), F.col(f"r.`{part}`") == F.col("s.of"))
           .select(*[F.col(f"r.`{c}`") for c in df.columns], (F.col("s.start") + F.col(f"r.`{at}`")).alias("row_number")))
    return out, int(total)


def give_back() -> None:
    """Return a Python worker's freed memory to the machine, at the end of a task that held much:
    workers live on, and other stages need it.  Nothing happens where the C library has no such call."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass


def worker_state() -> dict:
    """A dictionary that lives as long as the Python worker, for what is costly to load."""
    name = "ledgerlake_worker_state"
    return sys.modules.setdefault(name, types.ModuleType(name)).__dict__


def forget() -> None:
    """Drop what operators have kept in this worker: one that is short of memory takes its place."""
    own = worker_state()
    for key in [k for k in own if not isinstance(k, str)]:
        del own[key]


def texts(batch, column: str) -> list[str]:
    """A string column of an Arrow batch, null as the empty text."""
    return [x or "" for x in batch.column(column).to_pylist()]


def fresh(columns: list[str], name: str) -> str:
    """``name``, or that name with a number, such that no column has it (in any case of letters)."""
    taken, own, i = {c.lower() for c in columns}, name, 1
    while own.lower() in taken:
        own, i = f"{name}{i}", i + 1
    return own


def arrow_map(df: DataFrame, each, schema: str) -> DataFrame:
    """``mapInArrow`` of a function from one batch to any number of batches."""
    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            yield from each(batch)
    return df.mapInArrow(run, schema)
