"""Partial revenue of the fact, kept by date slice.

A slice of the summary holds the sums of one sale date by channel; it is replaced with the fact's slice of that date, so a
late refund or a redelivered sale changes its date's sums and no others.  Sums of sums give the published revenue
without reading the fact: the rows read are dates times channels.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlake.sinks import slices

SUMS = {"total_orders": "long", "total_units_sold": "long", "gross_revenue": "decimal(28,2)",
        "total_refunds": "decimal(28,2)", "net_revenue": "decimal(28,2)"}


def partial_revenue(fact: DataFrame) -> DataFrame:
    """sale_date, channel_key and the sums of that date and channel."""
    sums = [F.count("sale_id"), F.sum("quantity_sold"), F.sum("sales_amount"), F.sum("refund_amount"),
            F.sum(F.col("sales_amount") - F.col("refund_amount"))]
    return fact.groupBy("sale_date", "channel_key").agg(*[s.cast(t).alias(c) for s, (c, t) in zip(sums, SUMS.items())])


def replace(fact: DataFrame, path: str, dates: Callable[[Column], Column]) -> None:
    """Bring the summary of ``dates`` up to date from the fact's rows of those dates."""
    slices.replace(partial_revenue(fact), path, "sale_date", dates)


def revenue(spark: SparkSession, path: str, dim_channels: DataFrame, dates: Callable[[Column], Column] | None = None) -> DataFrame:
    """The published revenue per channel, of all dates or some, from the summary alone."""
    parts = slices.read(spark, path, "sale_date", f"sale_date date, channel_key long, {', '.join(f'{c} {t}' for c, t in SUMS.items())}",
                        dates)
    named = parts.join(F.broadcast(dim_channels.select("channel_key", "channel_name")), "channel_key")  # a row a marketplace
    out = {"total_orders": "bigint", "total_units_sold": "bigint"}
    return named.groupBy("channel_name").agg(*[F.sum(c).cast(out.get(c, "double")).alias(c) for c in SUMS]).orderBy(
        F.col("net_revenue").desc_nulls_last(), "channel_name")
