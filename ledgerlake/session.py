"""Session defaults and the shared working folder.

Only settings the pipeline depends on for *correct* results are forced
(UTC session time zone: ``to_date`` of an offset timestamp depends on it).
Everything else is a default that a cluster's own configuration wins over.
"""

from __future__ import annotations

import logging
import math
import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger("ledgerlake")

# Settings that change results: always applied.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
}

# Performance defaults (runtime SQL settings): applied only where the
# cluster / launcher has not set the key.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}

# Launch settings: no web UI / console progress (batch jobs, no open ports).
LAUNCH_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app_name: str = "ledgerlake",
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Return a session with the pipeline's defaults.

    ``master`` is only set when given (tests / bench pass ``local[N]``); on a
    cluster the launcher decides.  ``extra`` settings are applied as given.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**LAUNCH_CONF, **(extra or {}), **REQUIRED_CONF}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    conf = spark._jsparkSession.conf()
    for key, value in DEFAULT_CONF.items():
        if not conf.contains(key):
            spark.conf.set(key, value)
    apply_conf(spark)
    return spark


def apply_conf(spark: SparkSession) -> SparkSession:
    """Apply the required settings to an existing session (idempotent)."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder for checkpoints and intermediate tables.

    Read from ``spark.checkpoint.dir`` (or the context's ``setCheckpointDir``).
    Only a local-mode session without one
    (tests, the bench) gets a fresh scratch folder; a cluster session must
    name a shared one, because executors can be lost at any time and
    intermediate state has to outlive them.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        return conf_dir.rstrip("/")
    ctx_dir = spark.sparkContext._jsc.sc().getCheckpointDir()   # setCheckpointDir()
    if ctx_dir.isDefined():
        return str(ctx_dir.get()).rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; a cluster run needs a shared "
            "folder (HDFS / object store) for checkpoints and layer tables")
    # (spark.checkpoint.dir is a core setting: it cannot change at run time,
    # but the context's checkpoint folder can, and is found above next time)
    spark.sparkContext.setCheckpointDir(
        tempfile.mkdtemp(prefix="ledgerlake-", dir=os.environ.get("TMPDIR", "/tmp")))
    return str(spark.sparkContext._jsc.sc().getCheckpointDir().get()).rstrip("/")


def input_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Total size of files under ``paths``: a metadata call on the file system
    (one RPC on HDFS, a listing on object stores), no data read."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        total += path.getFileSystem(conf).getContentSummary(path).getLength()
    return int(total)


INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
TARGET_PARTITION_BYTES = 128 * 1024 * 1024
# Beyond this many reducers each takes more bytes instead (a sort spills, no row is affected):
# the blocks of a shuffle are mappers x reducers, and the driver keeps a map of them.
MOST_PARTITIONS = 40_000
# What whole rows take in a sort, by what they take in the compressed files of a layer, and by what
# they take in a shuffle, about.
IN_A_SORT, IN_A_SORT_BY_SHUFFLE = 32.0, 8.0
SPLIT_BYTES = "spark.sql.files.maxPartitionBytes"
ADVISORY_BYTES = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def reducers_for(n_bytes: int, parallelism: int, expansion: float = 4.0,
                 target_bytes: int = TARGET_PARTITION_BYTES, most: int = MOST_PARTITIONS) -> int:
    """Partitions for ``n_bytes`` of compressed columnar data: between the
    cluster's parallelism and ``most``."""
    return max(parallelism, min(most, math.ceil(n_bytes * expansion / target_bytes)))


def plan_bytes(df: DataFrame) -> int:
    """The optimizer's estimate of the bytes of ``df``: for files and tables their size."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def sized_session(spark: SparkSession, df: DataFrame, **kw) -> SparkSession:
    """A session of its own whose shuffles start with as many partitions as ``df`` needs.

    It shares the catalog and all settings of ``spark``, so other jobs of that
    session keep their own number.  A number the user has set is kept.
    """
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if own.conf.isModifiable(key):
            own.conf.set(key, value)
    if spark.conf.get(INITIAL_PARTITIONS, None) is None:
        own.conf.set(INITIAL_PARTITIONS, str(reducers_for(plan_bytes(df), spark.sparkContext.defaultParallelism, **kw)))
    return own


def sorting_session(spark: SparkSession, df: DataFrame, target_bytes: int = TARGET_PARTITION_BYTES) -> SparkSession:
    """:func:`sized_session` for jobs that sort whole rows of ``df``, where they are read and after a shuffle:
    a task, also one that AQE has merged, gets rows that take a small multiple of ``target_bytes`` in memory, so
    it spills nothing.  Beyond ``MOST_PARTITIONS`` tasks get more; settings of the user are kept."""
    own = sized_session(spark, df, expansion=IN_A_SORT, target_bytes=target_bytes)
    least = plan_bytes(df) / MOST_PARTITIONS
    given = spark.conf.getAll
    for key, factor in ((SPLIT_BYTES, 2 / IN_A_SORT), (ADVISORY_BYTES, 1 / IN_A_SORT_BY_SHUFFLE)):
        if key not in given:
            own.conf.set(key, str(math.ceil(max(target_bytes * factor, least * factor * IN_A_SORT))))
    return own


def partitions_for(spark: SparkSession, paths: list[str], expansion: float = 4.0,
                   target_bytes: int = TARGET_PARTITION_BYTES) -> int:
    """Partitions for data read from ``paths``: ``expansion`` converts
    compressed columnar bytes to in-flight row bytes; never below the
    cluster's parallelism."""
    parallelism = spark.sparkContext.defaultParallelism
    try:
        n_bytes = input_bytes(spark, paths)
    except Exception as error:       # sizing is an optimisation: never fail the job over it
        log.warning("the size of %s is unknown (%s): %d partitions", paths, str(error).split("\n")[0], parallelism)
        return parallelism
    return reducers_for(n_bytes, parallelism, expansion, target_bytes)


def size_shuffles(spark: SparkSession, paths: list[str], expansion: float = 4.0,
                  target_bytes: int = TARGET_PARTITION_BYTES) -> int:
    """Start shuffles with enough partitions for the input, let AQE coalesce.

    Sets ``spark.sql.adaptive.coalescePartitions.initialPartitionNum``: AQE
    can merge small post-shuffle partitions but never split a big one, so the
    starting number must fit the data.  Returns the number chosen.
    """
    n = partitions_for(spark, paths, expansion, target_bytes)
    spark.conf.set(INITIAL_PARTITIONS, str(n))
    return n


@contextmanager
def sized_shuffles(spark: SparkSession, paths: list[str], **kw):
    """:func:`size_shuffles` for the jobs run inside the block, then restore.

    A value the user set explicitly is kept (their sizing wins).
    """
    previous = spark.conf.get(INITIAL_PARTITIONS, None)
    if previous is not None:
        yield int(previous)
        return
    n = size_shuffles(spark, paths, **kw)
    try:
        yield n
    finally:
        spark.conf.unset(INITIAL_PARTITIONS)
