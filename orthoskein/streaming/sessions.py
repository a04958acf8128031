"""Gap sessions over streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def capture_sessions(rows: DataFrame, time: str, key: str, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """Sessions of each key with first and last time and count; an event exactly at the gap still joins.

    On a stream the gap is a parameter: three times a median of all intervals,
    as the batch form has it, is only known at the end.
    """
    marked = rows.withWatermark(time, late) if rows.isStreaming else rows
    out = marked.groupBy(key, F.session_window(time, gap).alias("w")).agg(F.min(time).alias("first"), F.max(time).alias("last"), F.count("*").alias("n"))
    return out.select(key, "first", "last", "n")
