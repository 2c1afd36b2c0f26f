"""Local rows and event files (layers are read by ``plans.jobs.LayerStore``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ledgerlake.schema import EVENT_SCHEMA


def from_rows(spark: SparkSession, rows: list, schema: StructType | str | list[str] | None = None
              ) -> DataFrame:
    """Literal rows -> DataFrame (column names, a DDL string or a StructType)."""
    return spark.createDataFrame(rows, schema)


def read_event_json(spark: SparkSession, path: str, schema: StructType = EVENT_SCHEMA,
                    multiline: bool = True) -> DataFrame:
    """Event files as written by the producers: one JSON array (indented) per
    file -> one row per element.  ``multiline=False`` reads JSON Lines, which
    splits across tasks; a multi-line file is read by one task per file."""
    return spark.read.schema(schema).option("multiLine", multiline).json(path)
