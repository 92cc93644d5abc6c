"""Which months to ingest, decided on the names of the monthly files.

The source job probes a web server for file names, month by month from "now"; here the look-back
spine is a small generated range, matched against the names in the landing folder, so no row is
read. ``as_of`` is always a parameter, never the wall clock, so results are reproducible.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiertrip.config import MONTH_FILE_PREFIX, MONTH_FILE_SUFFIX
from tiertrip.session import list_path

MONTH_PATTERN = re.escape(MONTH_FILE_PREFIX) + r"(\d{4}-(?:0[1-9]|1[0-2]))" + re.escape(MONTH_FILE_SUFFIX)


def month_files(spark: SparkSession, landing_path: str) -> dict[str, tuple[str, int]]:
    """``yyyy-MM`` -> (path, bytes) of the monthly files (or folders so named) in the landing folder:
    one entry per month, from a listing."""
    out = {}
    for path, size, _ in list_path(spark, landing_path):
        m = re.fullmatch(MONTH_PATTERN, path.rstrip("/").rsplit("/", 1)[-1])
        if m:
            out[m[1]] = (path, size)
    return out


def available_months(spark: SparkSession, landing_path: str) -> DataFrame:
    """First-of-month dates of the monthly files in the landing folder."""
    rows = [(m + "-01",) for m in sorted(month_files(spark, landing_path))]
    return spark.createDataFrame(rows, "m string").select(F.to_date("m").alias("month"))


def month_spine(spark: SparkSession, as_of: str, start_offset: int, max_lookback: int) -> DataFrame:
    """``offset, month`` for offsets ``start_offset..max_lookback`` back from ``as_of``'s month."""
    base = F.trunc(F.to_date(F.lit(as_of)), "month")
    return spark.range(start_offset, max_lookback + 1).select(
        F.col("id").cast("int").alias("months_back"),
        F.add_months(base, -F.col("id").cast("int")).alias("month"),
    )


def month_file(month_col) -> F.Column:
    """``fhvhv_tripdata_yyyy-MM.parquet`` for a month date."""
    return F.concat(F.lit(MONTH_FILE_PREFIX), F.date_format(month_col, "yyyy-MM"), F.lit(MONTH_FILE_SUFFIX))


def latest_months(available: DataFrame, as_of: str, start_offset: int = 2, max_lookback: int = 14,
                  n: int = 6) -> DataFrame:
    """SRC-7: the newest ``n`` months present within the look-back window, newest first."""
    spine = month_spine(available.sparkSession, as_of, start_offset, max_lookback)
    found = spine.join(available, "month", "left_semi")
    return (found.orderBy(F.col("month").desc()).limit(n)
            .select("months_back", F.date_format("month", "yyyy-MM").alias("month"), month_file(F.col("month")).alias("file")))


def missing_months(available: DataFrame, as_of: str, start_offset: int = 2, max_lookback: int = 14) -> DataFrame:
    """SRC-8: months probed in the window but absent from the data."""
    spine = month_spine(available.sparkSession, as_of, start_offset, max_lookback)
    return (spine.join(available, "month", "left_anti").orderBy("months_back")
            .select("months_back", F.date_format("month", "yyyy-MM").alias("month"), month_file(F.col("month")).alias("file")))
