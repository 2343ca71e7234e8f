"""Refund settlement: every refund is charged to the sale it names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlake import contracts as C
from martlake.operators.conform import RULE_REFUND
from martlake.operators.unify import pick_one


def dedup_refunds(refunds: DataFrame) -> DataFrame:
    """One row per refund_id: the newest delivery, ties by the other columns."""
    return pick_one(refunds, ["refund_id"], ["refund_date"], largest=True)


def refund_totals(refunds: DataFrame) -> DataFrame:
    """Refunded amount per original sale, each refund_id once (partial +
    final aggregation, so a sale refunded many times is combined map-side)."""
    return (dedup_refunds(refunds).groupBy("original_transaction_id")
            .agg(F.sum("refund_amount").cast(C.MONEY).alias("_refunded")))


def settle(sales: DataFrame, refunds: DataFrame) -> DataFrame:
    """Sales with ``refund_amount`` = sum of their feed refunds (+ the rule
    refund when present), 0.00 when none.

    Sales are unique per sale_id and refund totals unique per id, so the
    left join is one-to-one and cannot skew; both sides are hash-partitioned
    on the same key by their aggregations, so the sort-merge join reuses
    that partitioning (or AQE broadcasts the totals when they are small).
    """
    return settle_totals(sales, refund_totals(refunds))


def settle_totals(sales: DataFrame, totals: DataFrame) -> DataFrame:
    """The same with totals at hand (original_transaction_id, _refunded)."""
    joined = sales.join(totals, sales.sale_id == totals.original_transaction_id, "left")
    refund = F.coalesce(F.col("_refunded"), F.lit(0).cast(C.MONEY))
    if RULE_REFUND in sales.columns:
        refund = refund + F.coalesce(F.col(RULE_REFUND), F.lit(0).cast(C.MONEY))
    keep = [c for c in sales.columns if c != RULE_REFUND]
    return joined.select(*keep, refund.cast(C.MONEY).alias("refund_amount"))
