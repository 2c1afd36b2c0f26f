"""Monitoring: layer counts, reconciliation and the pipeline metrics record.

Each layer contributes one global aggregate (a count over Parquet is served
from footers; the risk split is three ``count_if`` in one pass).  The one-row
results are stacked with ``unionByName`` and folded by one more global
aggregate -- no join, no driver round trip, a single job.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.operators import gold
from ledgerlake.schema import RISK_LEVELS

PIPELINE_NAME = "ledgerlake"
STATUS = "SUCCESS"

COUNT_COLUMNS = [
    "bronze_records", "silver_records", "quarantined_records",
    "gold_risk_records", "high_risk_transactions", "medium_risk_transactions",
    "low_risk_transactions",
]


def _rows(alias: str):
    return F.count(F.lit(1)).alias(alias)


def _fold(parts: list[DataFrame], columns: list[str]) -> DataFrame:
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return stacked.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c)
                         for c in columns])


def percent(part: str, whole: str):
    """``part / whole * 100`` rounded to 2; NULL (not an error) when whole = 0."""
    return F.round(F.try_divide(F.col(part), F.col(whole)) * 100, 2)


def layer_counts(bronze: DataFrame, silver: DataFrame, quarantine: DataFrame,
                 risk_rows: DataFrame) -> DataFrame:
    level = F.col("risk_level")
    risk = risk_rows.agg(
        _rows("gold_risk_records"),
        *[F.count_if(level == lv).alias(f"{lv.lower()}_risk_transactions")
          for lv in RISK_LEVELS])
    return _fold([bronze.agg(_rows("bronze_records")),
                  silver.agg(_rows("silver_records")),
                  quarantine.agg(_rows("quarantined_records")),
                  risk], COUNT_COLUMNS)


def monitoring_record(bronze: DataFrame, silver: DataFrame, quarantine: DataFrame,
                      risk_rows: DataFrame, generated_at: bool = False,
                      pipeline_name: str = PIPELINE_NAME) -> DataFrame:
    """The monitoring record as a one-row frame (same keys as the JSON)."""
    out = layer_counts(bronze, silver, quarantine, risk_rows)
    out = out.select(
        F.lit(pipeline_name).alias("pipeline_name"),
        F.lit(STATUS).alias("status"),
        *COUNT_COLUMNS[:3],
        (F.col("bronze_records") - F.col("silver_records")
         - F.col("quarantined_records")).alias("records_removed_during_quality_processing"),
        *COUNT_COLUMNS[3:],
        percent("silver_records", "bronze_records").alias("silver_retention_rate_percent"),
        percent("quarantined_records", "bronze_records").alias("quarantine_rate_percent"),
    )
    if generated_at:
        out = out.withColumn("generated_at_utc",
                             F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"))
    return out


def risk_distribution(risk_rows: DataFrame) -> DataFrame:
    """risk_level -> count (one grouped aggregate)."""
    return risk_rows.groupBy("risk_level").count()


def duplicates_removed(valid_before_dedup: DataFrame, silver: DataFrame) -> DataFrame:
    """Valid rows before dedup, silver rows, and their difference (one row)."""
    out = _fold([valid_before_dedup.agg(_rows("valid_before_dedup")),
                 silver.agg(_rows("silver_records"))],
                ["valid_before_dedup", "silver_records"])
    return out.withColumn("duplicates_removed",
                          F.col("valid_before_dedup") - F.col("silver_records"))


def batch_stream_reconcile(batch_bronze: DataFrame, stream_bronze: DataFrame) -> DataFrame:
    """Row counts of the bounded and the streaming bronze, and whether they agree."""
    out = _fold([batch_bronze.agg(_rows("bronze_batch_records")),
                 stream_bronze.agg(_rows("bronze_streaming_records"))],
                ["bronze_batch_records", "bronze_streaming_records"])
    return out.withColumn("counts_match",
                          F.col("bronze_batch_records") == F.col("bronze_streaming_records"))


def total_value(silver: DataFrame, money_mode: str = "decimal") -> DataFrame:
    """Sum of all silver amounts (one row)."""
    return gold.total_value(silver, money_mode)
