"""The lakehouse's data flow, composed from the operators.

feeds -> quality split -> conform -> union -> dedup -> refund settlement
      -> dimensions -> fact key lookup -> channel revenue

Each function returns a lazy DataFrame; Catalyst sees the whole plan, so
filters and column pruning reach the scans.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlake import contracts as C
from martlake.operators import conform, dimensions, facts, quality, refunds, unify
from martlake.sources import fixtures


@dataclass
class Feeds:
    orders: DataFrame
    sales: DataFrame
    refunds: DataFrame
    products: DataFrame
    customers: DataFrame
    # array<string> columns with parse errors of text feeds, if any
    orders_errors: str | None = None
    sales_errors: str | None = None


def feeds_from_tables(spark: SparkSession, sf_dir: str) -> Feeds:
    return Feeds(**{name: fn(spark, sf_dir) for name, fn in fixtures.FEEDS.items()})


def classified_orders(feeds: Feeds) -> DataFrame:
    return quality.classify(feeds.orders, quality.web_order_rules(), feeds.orders_errors)


def classified_sales(feeds: Feeds) -> DataFrame:
    return quality.classify(feeds.sales, quality.mkt_sale_rules(), feeds.sales_errors)


def valid_orders(feeds: Feeds) -> DataFrame:
    return quality.only_valid(feeds.orders, quality.web_order_rules(), feeds.orders_errors)


def valid_sales(feeds: Feeds) -> DataFrame:
    return quality.only_valid(feeds.sales, quality.mkt_sale_rules(), feeds.sales_errors)


def valid_refunds(feeds: Feeds) -> DataFrame:
    return quality.only_valid(feeds.refunds, quality.refund_rules())


def unified_sales(feeds: Feeds, as_of: dt.datetime | None = None, refund_rule: bool = False) -> DataFrame:
    web = conform.web_sales(valid_orders(feeds), as_of, refund_rule)
    mkt = conform.marketplace_sales(valid_sales(feeds), refund_rule)
    return unify.union_all(web, mkt)


def curated_sales(feeds: Feeds, as_of: dt.datetime | None = None, refund_rule: bool = False) -> DataFrame:
    return unify.dedup_sales(unified_sales(feeds, as_of, refund_rule))


def settled_sales(feeds: Feeds, as_of: dt.datetime | None = None, refund_rule: bool = False) -> DataFrame:
    return refunds.settle(curated_sales(feeds, as_of, refund_rule), valid_refunds(feeds))


def redated(settled: DataFrame, feeds: Feeds, given: DataFrame, as_of: dt.datetime) -> DataFrame:
    """``settled_sales`` with ``as_of`` (by the refund rule) from those ``settled`` without: only sales with a delivery
    that has no time are picked and settled again."""
    undated = unified_sales(feeds).filter("transaction_date IS NULL").select("sale_id").distinct()
    again = unified_sales(feeds, as_of, refund_rule=True).join(undated, "sale_id", "left_semi")
    return settled.join(undated, "sale_id", "left_anti").unionByName(refunds.settle(unify.dedup_sales(again), given))


def unified_customers(feeds: Feeds) -> DataFrame:
    web = conform.web_customers(feeds.customers)
    mkt = conform.marketplace_customers(valid_sales(feeds))
    return unify.union_all(web, mkt)


def curated_customers(feeds: Feeds) -> DataFrame:
    return unify.dedup_customers(unified_customers(feeds), ["customer_id", "source_system"])


def curated_products(feeds: Feeds) -> DataFrame:
    return conform.products(feeds.products)


def dim_products(feeds: Feeds, current: DataFrame | None = None) -> DataFrame:
    key, nat = C.DIM_PRODUCTS_KEY
    return dimensions.scd1_upsert(current, curated_products(feeds), key, nat, "product_name")


def dim_customers(feeds: Feeds, current: DataFrame | None = None) -> DataFrame:
    key, nat = C.DIM_CUSTOMERS_KEY
    return dimensions.scd1_upsert(current, curated_customers(feeds), key, nat, "first_name")


def fact_sales(spark: SparkSession, feeds: Feeds, as_of: dt.datetime | None = None,
               refund_rule: bool = True, dims: tuple[DataFrame, DataFrame] | None = None,
               product_source: str = "channel_map") -> DataFrame:
    settled = settled_sales(feeds, as_of, refund_rule)
    dp, dc = dims if dims is not None else (dim_products(feeds), dim_customers(feeds))
    ch = channel_dim(spark, feeds)
    return facts.lookup_keys(settled, dp, dc, ch, as_of, product_source)


def channel_dim(spark: SparkSession, feeds: Feeds) -> DataFrame:
    """Seeded channels plus marketplaces seen in the valid sales feed (the
    website channel is seeded); reads only the marketplace name column."""
    mkt = valid_sales(feeds).select(F.col("marketplace_name").alias("channel_name"))
    return dimensions.channels(spark, mkt)


def channel_revenue(settled: DataFrame, dim_channels: DataFrame) -> DataFrame:
    """Orders, units, gross, refunds and net revenue per channel.

    The sales are aggregated per channel_name first (partial aggregation on
    every map task, a handful of groups) and only the aggregate meets the
    channel dimension: the inner join is between a few rows on each side.
    """
    per_channel = settled.groupBy("channel_name").agg(
        F.count("sale_id").alias("total_orders"),
        F.sum("quantity_sold").alias("total_units_sold"),
        F.sum("sales_amount").alias("gross_revenue"),
        F.sum("refund_amount").alias("total_refunds"),
        F.sum(F.col("sales_amount") - F.col("refund_amount")).alias("net_revenue"))
    named = per_channel.join(F.broadcast(dim_channels.select("channel_name")), "channel_name")
    return named.select(
        "channel_name",
        F.col("total_orders").cast("bigint").alias("total_orders"),
        F.col("total_units_sold").cast("bigint").alias("total_units_sold"),
        F.col("gross_revenue").cast("double").alias("gross_revenue"),
        F.col("total_refunds").cast("double").alias("total_refunds"),
        F.col("net_revenue").cast("double").alias("net_revenue"),
    ).orderBy(F.col("net_revenue").desc_nulls_last(), "channel_name")


def fact_channel_revenue(fact: DataFrame, dim_channels: DataFrame) -> DataFrame:
    """The published query over the loaded star schema: fact JOIN dim_channels."""
    per_key = fact.groupBy("channel_key").agg(
        F.count("sale_id").alias("total_orders"),
        F.sum("quantity_sold").alias("total_units_sold"),
        F.sum("sales_amount").alias("gross_revenue"),
        F.sum("refund_amount").alias("total_refunds"),
        F.sum(F.col("sales_amount") - F.col("refund_amount")).alias("net_revenue"))
    named = per_key.join(F.broadcast(dim_channels.select("channel_key", "channel_name")), "channel_key")
    return channel_revenue_shape(named)


def channel_revenue_shape(named: DataFrame) -> DataFrame:
    return named.groupBy("channel_name").agg(
        F.sum("total_orders").cast("bigint").alias("total_orders"),
        F.sum("total_units_sold").cast("bigint").alias("total_units_sold"),
        F.sum("gross_revenue").cast("double").alias("gross_revenue"),
        F.sum("total_refunds").cast("double").alias("total_refunds"),
        F.sum("net_revenue").cast("double").alias("net_revenue"),
    ).orderBy(F.col("net_revenue").desc_nulls_last(), "channel_name")
