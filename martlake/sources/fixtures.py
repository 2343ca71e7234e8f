"""Operational feeds derived from the benchmark tables.

The benchmark tables (TPC-H-like ``lineitem orders part customer`` and the
``events`` stream) stand in for the operational database and the
marketplace feeds.  They hold no dirty values, so a few are planted by plain
arithmetic on the data; the same definitions exist as SQL in
``martlake.plans.oracle`` for the DuckDB check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlake import contracts as C


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


def web_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order feed: one order per line item, with planted NULLs, non-positive
    quantities, cancelled and refunded statuses."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_returnflag")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    j = li.join(od, li.l_orderkey == od.o_orderkey)
    status = (F.when((F.col("l_linenumber") == 1) & (F.col("o_orderstatus") == "P"), F.lit(C.CANCELLED_STATUS))
               .when(F.col("l_linenumber") == 7, F.lit(None).cast("string"))
               .when(F.col("l_returnflag") == "R", F.lit(C.REFUNDED_STATUS))
               .otherwise(F.lit("Completed")))
    return j.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.when(F.col("l_partkey") % 97 == 0, F.lit(None)).otherwise(F.col("l_partkey")).alias("product_id"),
        F.when(F.col("l_partkey") % 89 == 0, F.lit(None))
         .otherwise(F.col("l_quantity").cast("int") - 2).alias("quantity"),
        F.col("l_extendedprice").cast(C.MONEY).alias("total_amount"),
        status.alias("order_status"),
        F.col("o_orderdate").alias("created_at"),
    )


def mkt_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marketplace sales feed from purchase/click events."""
    ev = table(spark, sf_dir, "events").filter(F.col("event_type").isin("purchase", "click"))
    uid = F.col("user_id")
    return ev.select(
        F.concat(F.lit("MKT-"), F.col("event_id")).alias("transaction_id"),
        (F.col("event_id") % 200).alias("product_id"),
        F.when(uid % 50 == 7, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("user"), uid, F.lit("@email.com"))).alias("customer_email"),
        F.when(uid % 5 == 0, F.concat(F.lit("User"), uid))
         .otherwise(F.concat(F.lit("User N"), uid, F.lit(" Extra"))).alias("customer_name"),
        F.when(F.col("event_type") == "purchase", F.lit("Amazon")).otherwise(F.lit("Flipkart"))
         .alias("marketplace_name"),
        (F.col("event_id") % 7).cast("int").alias("quantity"),
        F.col("value").cast(C.MONEY).alias("amount"),
        F.col("ts").alias("transaction_date"),
    )


def mkt_refunds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marketplace refunds feed: every 11th purchase/click event refunded."""
    ev = table(spark, sf_dir, "events").filter(
        F.col("event_type").isin("purchase", "click") & (F.col("event_id") % 11 == 0))
    return ev.select(
        F.concat(F.lit("MKT-REF-"), F.col("event_id")).alias("refund_id"),
        F.concat(F.lit("MKT-"), F.col("event_id")).alias("original_transaction_id"),
        F.col("value").cast(C.MONEY).alias("refund_amount"),
        F.concat(F.lit("user"), F.col("user_id"), F.lit("@email.com")).alias("customer_email"),
        F.col("ts").alias("refund_date"),
    )


def web_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"), F.col("p_retailprice").cast(C.MONEY).alias("price"))


def web_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    ck = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        ck.alias("customer_id"), F.lit("Customer").alias("first_name"),
        F.substring(F.col("c_name"), 10, 1 << 30).alias("last_name"),
        F.concat(F.lit("cust"), ck, F.lit("@email.com")).alias("email"),
        F.when(ck % 10 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("98"), ck)).alias("phone"))


def created(table: DataFrame, key: str) -> DataFrame:
    """The operational table's ``created_at``: a day of 2024 by the key."""
    return table.withColumn("created_at", F.expr(f"TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval({key} % 365)"))


FEEDS = {
    "orders": web_orders,
    "sales": mkt_sales,
    "refunds": mkt_refunds,
    "products": web_products,
    "customers": web_customers,
}
