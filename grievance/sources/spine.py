"""Calendar spine for the date dimension."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grievance.schemas import DATE_SPINE_END, DATE_SPINE_START


def date_spine(spark: SparkSession, start: str = DATE_SPINE_START, end: str = DATE_SPINE_END) -> DataFrame:
    """One row per day in [start, end) as column ``date_day`` (end exclusive).

    Generated with ``range`` so it is split across tasks like any scan, not
    built as a driver-side list.
    """
    d0, d1 = dt.date.fromisoformat(start), dt.date.fromisoformat(end)
    n = (d1 - d0).days
    return spark.range(0, max(n, 0)).select(
        F.date_add(F.lit(d0), F.col("id").cast("int")).alias("date_day")
    )
