"""Sales fact: surrogate-key lookup."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlake import contracts as C
from martlake.functions import scalars as S

def customer_source(channel: str = "channel_name"):
    """Customers of the website are the operational DB's; marketplace
    shoppers are keyed under their marketplace's name."""
    return F.when(F.col(channel) == C.WEB_CHANNEL, F.lit(C.WEB_SOURCE_SYSTEM)).otherwise(F.col(channel))


def lookup_keys(sales: DataFrame, dim_products: DataFrame, dim_customers: DataFrame,
                dim_channels: DataFrame, as_of: dt.datetime | None = None,
                product_source: str = "channel_map") -> DataFrame:
    """Left-join settled sales to the three dimensions (unmatched -> NULL key).

    Only the channel dimension (a row per marketplace) is broadcast by hint;
    for products and customers adaptive execution decides by measured bytes.

    ``product_source='channel_map'`` takes each channel's catalogue from
    ``dim_channels.product_source``; ``'case'`` is the literal mapping
    Website -> MySQL, others -> 'Marketplace API'.
    """
    ch = F.broadcast(dim_channels.select(
        "channel_name", "channel_key", F.col("product_source").alias("_psrc")))
    s = sales.join(ch, "channel_name", "left")
    if product_source == "case":
        psrc = F.when(F.col("channel_name") == C.WEB_CHANNEL, F.lit(C.WEB_SOURCE_SYSTEM)) \
                .otherwise(F.lit("Marketplace API"))
    else:
        psrc = F.col("_psrc")
    s = s.withColumn("_psrc", psrc).withColumn("_csrc", customer_source())
    p = dim_products.select(
        F.col("product_id").alias("_p_id"), F.col("source_system").alias("_p_src"), "product_key")
    c = dim_customers.select(
        F.col("customer_id").alias("_c_id"), F.col("source_system").alias("_c_src"), "customer_key")
    s = s.join(p, (s.product_id == p._p_id) & (s._psrc == p._p_src), "left")
    s = s.join(c, (s.customer_id == c._c_id) & (s._csrc == c._c_src), "left")
    ingest = S.ntz(as_of) if as_of is not None else F.lit(None).cast("timestamp_ntz")
    refund = F.col("refund_amount") if "refund_amount" in sales.columns else F.lit(None)
    return s.select(
        "sale_id", F.col("product_key").cast("bigint"), F.col("customer_key").cast("bigint"),
        F.col("channel_key").cast("bigint"), "quantity_sold", "sales_amount",
        F.coalesce(refund.cast(C.MONEY), F.lit(0).cast(C.MONEY)).alias("refund_amount"),
        "transaction_date", ingest.alias("ingestion_timestamp"),
        S.sale_date("transaction_date").alias("sale_date"))


def orphans(fact: DataFrame) -> DataFrame:
    """Fact rows whose foreign keys found no dimension member."""
    missing = F.filter(F.array(
        F.when(F.col("product_key").isNull(), F.lit("product")),
        F.when(F.col("customer_key").isNull(), F.lit("customer")),
        F.when(F.col("channel_key").isNull(), F.lit("channel"))), lambda x: x.isNotNull())
    return fact.select("sale_id", missing.alias("missing")).filter(F.size("missing") > 0)
