"""Conform each channel's valid rows to the canonical sales schema, and the
catalogue/customer feeds to the curated dimension inputs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlake import contracts as C
from martlake.functions import scalars as S

RULE_REFUND = "rule_refund"


def web_sales(valid_orders: DataFrame, as_of: dt.datetime | None = None,
              refund_rule: bool = False) -> DataFrame:
    """Website orders -> sales.  A missing ``created_at`` takes the run's
    ``as_of`` time (a parameter, so reruns are reproducible).  With
    ``refund_rule`` an order whose status is Refunded carries its full
    amount in ``rule_refund``."""
    ts = F.col("created_at")
    if as_of is not None:
        ts = F.coalesce(ts, S.ntz(as_of))
    cols = [
        S.web_sale_id("order_id").alias("sale_id"),
        F.col("product_id").cast("bigint").alias("product_id"),
        F.col("customer_id").cast("bigint").alias("customer_id"),
        F.lit(None).cast("string").alias("customer_email"),
        F.lit(C.WEB_CHANNEL).alias("channel_name"),
        F.col("quantity").cast("int").alias("quantity_sold"),
        F.col("total_amount").cast(C.MONEY).alias("sales_amount"),
        ts.alias("transaction_date"),
    ]
    if refund_rule:
        cols.append(F.when(F.col("order_status") == C.REFUNDED_STATUS, F.col("total_amount"))
                     .otherwise(F.lit(0).cast(C.MONEY)).cast(C.MONEY).alias(RULE_REFUND))
    return valid_orders.select(*cols)


def marketplace_sales(valid_sales: DataFrame, refund_rule: bool = False) -> DataFrame:
    cols = [
        F.col("transaction_id").alias("sale_id"),
        F.col("product_id").cast("bigint").alias("product_id"),
        S.identity_md5("customer_email").alias("customer_id"),
        F.col("customer_email"),
        F.col("marketplace_name").alias("channel_name"),
        F.col("quantity").cast("int").alias("quantity_sold"),
        F.col("amount").cast(C.MONEY).alias("sales_amount"),
        F.col("transaction_date"),
    ]
    if refund_rule:
        cols.append(F.lit(0).cast(C.MONEY).alias(RULE_REFUND))
    return valid_sales.select(*cols)


def products(web_products: DataFrame, source_system: str = C.WEB_SOURCE_SYSTEM) -> DataFrame:
    return web_products.select(
        F.col("product_id").cast("bigint"), "product_name", "category",
        F.col("price").cast(C.MONEY), F.lit(source_system).alias("source_system"))


def web_customers(customers: DataFrame) -> DataFrame:
    return customers.select(
        F.col("customer_id").cast("bigint"), "first_name", "last_name", "email", "phone",
        F.lit(C.WEB_SOURCE_SYSTEM).alias("source_system"))


def marketplace_customers(valid_sales: DataFrame) -> DataFrame:
    """One row per valid marketplace sale (not yet de-duplicated).  The
    customer's grain is (e-mail, marketplace): a shopper on two marketplaces
    is two customers, so both channels' sales find their key."""
    return valid_sales.select(
        S.identity_md5("customer_email").alias("customer_id"),
        S.first_name("customer_name").alias("first_name"),
        S.last_name("customer_name").alias("last_name"),
        F.col("customer_email").alias("email"),
        F.lit(None).cast("string").alias("phone"),
        F.col("marketplace_name").alias("source_system"))
