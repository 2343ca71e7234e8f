"""Sinks: landing CSV/NDJSON, curated Parquet (replaceable slices: slices.py).

Every write is an overwrite of exactly the partitions it produces (dynamic
partition overwrite), so rerunning a job for the same dates gives the same
files instead of adding duplicates.
"""

from __future__ import annotations


from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlake import contracts as C

_DYNAMIC = {"partitionOverwriteMode": "dynamic"}


def _writer(df: DataFrame, partition_by: list[str] | None, day_of: str | None = None, compression: str | None = None):
    if day_of:
        df = with_dated_keys(df.withColumn("_day", F.to_date(day_of)).hint("rebalance", "_day").drop("_day"), day_of)
        partition_by = ["year", "month", "day"]
    elif partition_by:
        df = df.hint("rebalance", *partition_by)
    w = df.write.mode("overwrite").options(**_DYNAMIC)
    if compression:
        w = w.option("compression", compression)
    return w.partitionBy(*partition_by) if partition_by else w


def write_csv_landing(df: DataFrame, path: str, partition_by: list[str] | None = None,
                      skip_empty: bool = False, day_of: str | None = None, compression: str | None = None) -> bool:
    """Header row, times as 'yyyy-MM-dd HH:mm:ss', NULL as an empty field.
    With ``skip_empty`` an empty extract writes nothing and returns False
    (readers fall back to an empty frame of the contract).  ``day_of`` (a
    time column) writes day folders, whose keys are made after the shuffle;
    ``compression`` is a codec's name (gzip; readers take both forms)."""
    if skip_empty and df.isEmpty():
        return False
    (_writer(df, partition_by, day_of, compression).option("header", True)
     .option("timestampNTZFormat", C.LANDING_TIMESTAMP_FORMAT)
     .option("nullValue", "").csv(path))
    return True


def write_ndjson_landing(df: DataFrame, path: str, partition_by: list[str] | None = None,
                         skip_empty: bool = False, day_of: str | None = None, compression: str | None = None) -> bool:
    """One JSON object per line; times as 'yyyy-MM-dd HH:mm:ss'.  ``day_of`` and ``compression`` as above."""
    if skip_empty and df.isEmpty():
        return False
    (_writer(df, partition_by, day_of, compression).option("timestampNTZFormat", C.LANDING_TIMESTAMP_FORMAT)
     .json(path))
    return True


def with_dated_keys(df: DataFrame, ts_col: str) -> DataFrame:
    """Zero-padded year=YYYY/month=MM/day=DD landing keys of a timestamp."""
    return (df.withColumn("year", F.date_format(ts_col, "yyyy"))
              .withColumn("month", F.date_format(ts_col, "MM"))
              .withColumn("day", F.date_format(ts_col, "dd")))


def write_partitioned_parquet(df: DataFrame, path: str, partition_by: list[str]) -> None:
    _writer(df, partition_by).parquet(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)
