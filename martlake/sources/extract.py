"""Extracts from the operational database.

``full_extract`` and ``day_extract`` define what is taken (the contract's
columns; orders by a half-open range on ``created_at``, which stays
sargable and is pushed to the source).  ``jdbc_table`` is the production
reader: a partitioned JDBC scan, one task per slice of the partition column.
The extracts take any DataFrame over the table, so the benchmark tables
stand in for the database in tests (no database is started here).
"""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlake.functions import scalars as S

CUSTOMER_COLUMNS = ["customer_id", "first_name", "last_name", "email", "phone", "created_at"]
PRODUCT_COLUMNS = ["product_id", "product_name", "category", "price", "created_at"]
ORDER_COLUMNS = ["order_id", "customer_id", "product_id", "quantity", "total_amount",
                 "order_status", "created_at"]


def jdbc_options(**overrides: str) -> dict[str, str]:
    """Connection options: explicit values first, else the environment
    (JDBC_URL, JDBC_USER, JDBC_PASSWORD).  Credentials are never hard-coded."""
    opts = {
        "url": os.getenv("JDBC_URL", ""),
        "user": os.getenv("JDBC_USER", ""),
        "password": os.getenv("JDBC_PASSWORD", ""),
        "fetchsize": "10000",
    }
    opts.update(overrides)
    return opts


def jdbc_table(spark: SparkSession, table: str, partition_column: str, lower: int, upper: int,
               num_partitions: int, **options: str) -> DataFrame:
    """Parallel JDBC read: ``num_partitions`` range queries on the column."""
    return (spark.read.format("jdbc").options(**jdbc_options(**options))
            .option("dbtable", table)
            .option("partitionColumn", partition_column)
            .option("lowerBound", str(lower)).option("upperBound", str(upper))
            .option("numPartitions", str(num_partitions)).load())


def full_extract(table: DataFrame, columns: list[str]) -> DataFrame:
    return table.select(*columns)


def day_extract(orders: DataFrame, start: dt.date, end: dt.date | None = None) -> DataFrame:
    """Orders created in [start, end) (end defaults to the next day)."""
    end = end or (start + dt.timedelta(days=1))
    lo = dt.datetime.combine(start, dt.time())
    hi = dt.datetime.combine(end, dt.time())
    ts = F.col("created_at")
    return orders.filter((ts >= S.ntz(lo)) & (ts < S.ntz(hi))) \
                 .select(*ORDER_COLUMNS)
