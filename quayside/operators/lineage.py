"""Lineage columns (P3) and the run stamp."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.dates import FOLDER_DATE_PATTERN
from quayside.functions.names import col

SOURCE_PATH = "source_path"
INGESTION_DATE = "ingestion_date"
PROCESSING_TIME = "processing_time"
LINEAGE_COLUMNS = (SOURCE_PATH, INGESTION_DATE, PROCESSING_TIME)

# Name of the folder that directly contains the file: ".../<yyyyMMdd>/<file>".
_PARENT_FOLDER = r"/([^/]+)/[^/]+$"


def folder_date(path: Column) -> Column:
    """Delivery date parsed from the parent folder name; null when it is not a date."""
    return F.try_to_date(F.regexp_extract(path, _PARENT_FOLDER, 1), FOLDER_DATE_PATTERN)


def add_lineage(df: DataFrame, path_column: str = SOURCE_PATH) -> DataFrame:
    """Append ``ingestion_date`` (from the folder) and ``processing_time`` (query time).

    ``path_column`` must already hold the scan's file path (taken from
    ``_metadata.file_path`` by the reader, so a shuffle cannot blank it).
    """
    data = [c for c in df.columns if c != path_column]
    return df.select(*[col(c) for c in data],
                     col(path_column).alias(SOURCE_PATH),
                     folder_date(col(path_column)).alias(INGESTION_DATE),
                     F.current_timestamp().alias(PROCESSING_TIME))


def stamp_run(df: DataFrame, at: dt.datetime | None = None) -> DataFrame:
    """Set ``processing_time`` to one driver-side UTC instant, constant for the run."""
    at = at or dt.datetime.now(dt.timezone.utc)
    return df.withColumn(PROCESSING_TIME, F.lit(at).cast("timestamp"))
