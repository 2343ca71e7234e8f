"""What earlier runs loaded, looked up by key.

Two tables keep, split by hash bucket of the key, what a load must know of the history, so that it reads the buckets
its ids hash to instead of all staged slices:

* the sale index: for every sale the dates of its deliveries and the newest time on each, by landing day (a landing
  day that is loaded again replaces its entries); and, again, the sales that stand on several dates (``moved``);
* the refund index: every refund's deliveries by landing day, and each sale's refunded total.  A run takes the
  refunds it touches, compares the delivery that counted before with the one that counts now, and merges the
  difference into the totals: replaced, moved and withdrawn refunds are taken back.  Deliveries and totals are one
  table, so both change with one commit.

A bucket is rewritten when a run touches it.  What goes to the driver is bucket numbers (``BUCKETS`` at most).
"""

from __future__ import annotations

from functools import reduce
from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlake import contracts as C
from martlake.operators.dimensions import PACKED
from martlake.operators.refunds import dedup_refunds
from martlake.session import scratch_path
from martlake.sinks import slices

BUCKETS = 256
_ENTRY = [T.StructField("landing_day", T.DateType()), T.StructField("bucket", T.IntegerType())]
SALES = T.StructType([T.StructField("moved", T.BooleanType()), T.StructField("sale_id", T.StringType()),
                      T.StructField("sale_date", T.DateType()), T.StructField("newest", C.TS), *_ENTRY])
_TOTAL = T.DecimalType(20, 2)
REFUNDS = T.StructType([T.StructField("is_total", T.BooleanType()),
                        *[T.StructField(f.name, _TOTAL if f.dataType == C.MONEY else f.dataType) for f in C.MKT_REFUNDS.fields],
                        T.StructField("refunds", T.LongType()), *_ENTRY])

Scope = Callable[[Column], Column]


def bucket(key: str | Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def buckets_of(*keys: DataFrame) -> list[int]:
    """The buckets of frames of one key column."""
    numbers = [k.select(bucket(k.columns[0]).alias("bucket")) for k in keys]
    return sorted(r[0] for r in reduce(DataFrame.union, numbers).distinct().collect())


def within(numbers: list[int]) -> Scope:
    return lambda b: b.isin(numbers) if numbers else F.lit(False)


def _staged(df: DataFrame, name: str) -> DataFrame:
    """Written and read back: several steps read it, one of them replaces its source."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", PACKED).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def halves(rows: DataFrame, key: str, keys: DataFrame) -> tuple[DataFrame, DataFrame] | None:
    """``rows`` in two, without a shuffle of them: those whose ``key`` is one of ``keys`` (one column of hashes, ``hashed``)
    and perhaps a few others, whose hash is the same; and the rest.  None where the keys are too many to broadcast:
    the choice is made by their number, since a shuffle that has begun is not taken back."""
    spark, name = rows.sparkSession, keys.columns[0]
    few = _staged(keys.distinct(), "keys")
    if few.count() * 8 > spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold():
        return None
    named = rows.withColumn(name, F.xxhash64(key))
    return tuple(named.join(F.broadcast(few), name, how).drop(name) for how in ("left_semi", "left_anti"))


def hashed(key: str) -> Column:
    return F.xxhash64(key).alias("_hash")


# ---------------------------------------------------------------------------
# Sales
# ---------------------------------------------------------------------------
def sale_entries(spark: SparkSession, path: str, ids: DataFrame | None = None) -> DataFrame:
    """The index's deliveries, all of them or those of the sales ``ids`` (sale_id), read from their buckets."""
    if ids is None:
        return slices.read(spark, path, "bucket", SALES).filter("NOT moved")
    found = slices.read(spark, path, "bucket", SALES, within(buckets_of(ids))).filter("NOT moved")
    return found.join(ids.select("sale_id").distinct(), "sale_id", "left_semi")


def moved_sales(spark: SparkSession, path: str) -> DataFrame:
    """sale_id, newest of the sales that were delivered for several dates."""
    return slices.read(spark, path, "bucket", SALES).filter("moved").select("sale_id", "newest")


def update_sales(deliveries: DataFrame, path: str, ids: DataFrame, reloaded: Scope) -> None:
    """Replace the entries of the landing days in ``reloaded`` by ``deliveries`` (sale_id, sale_date, newest,
    landing_day), in the buckets of ``ids``, which names every sale that differs."""
    spark, numbers = deliveries.sparkSession, buckets_of(ids)
    kept = (slices.read(spark, path, "bucket", SALES, within(numbers))
            .filter(~F.col("moved") & ~F.coalesce(reloaded(F.col("landing_day")), F.lit(False))).drop("moved"))
    mine = (deliveries.groupBy("sale_id", "sale_date", "landing_day").agg(F.max("newest").alias("newest"))
            .withColumn("bucket", bucket("sale_id")).filter(within(numbers)(F.col("bucket"))))
    # a bucket's entries come together once (in parts where there are more tasks than buckets), and so do a sale's, which
    # tell whether it stands on several dates: both readers take all columns, so one shuffle serves them
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // BUCKETS)
    entries = (kept.unionByName(mine).select("sale_id", "sale_date", "newest", "landing_day", "bucket")
               .withColumn("_part", F.pmod(F.hash("sale_id"), F.lit(parts))).repartition("bucket", "_part"))
    several = entries.groupBy("bucket", "_part", "sale_id").agg(
        F.min("sale_date").alias("_first"), F.max("sale_date").alias("sale_date"), F.max("newest").alias("newest"),
        F.max("landing_day").alias("_day")).filter("_first < sale_date")
    moved = several.withColumn("landing_day", F.when(F.col("_first") >= F.col("sale_date"), F.col("_day")))  # of none: NULL
    rows = entries.withColumn("moved", F.lit(False)).select(*SALES.fieldNames()).unionByName(
        moved.withColumn("moved", F.lit(True)).select(*SALES.fieldNames()))
    slices.replace(rows.sortWithinPartitions("bucket"), path, "bucket", within(numbers), clustered=True)


# ---------------------------------------------------------------------------
# Refunds
# ---------------------------------------------------------------------------
def _deliveries(spark: SparkSession, path: str, numbers: list[int]) -> DataFrame:
    return slices.read(spark, path, "bucket", REFUNDS, within(numbers)).filter("NOT is_total")


def refund_totals(spark: SparkSession, path: str, sale_ids: DataFrame | None = None) -> DataFrame:
    """original_transaction_id, _refunded of every refunded sale, or of those in the buckets of ``sale_ids``."""
    where = None if sale_ids is None else within(buckets_of(sale_ids))
    return (slices.read(spark, path, "bucket", REFUNDS, where).filter("is_total")
            .select("original_transaction_id", F.col("refund_amount").cast(C.MONEY).alias("_refunded")))


def _charged(deliveries: DataFrame, sign: int) -> DataFrame:
    """What the delivery that counts of each refund adds to its sale."""
    counted = dedup_refunds(deliveries.select(*C.MKT_REFUNDS.fieldNames()))
    return counted.select("original_transaction_id", (F.col("refund_amount") * sign).cast(_TOTAL).alias("refund_amount"),
                          F.lit(sign).cast("long").alias("refunds"))


def update_refunds(deliveries: DataFrame, path: str, refund_ids: DataFrame, reloaded: Scope,
                   before_commit: Callable[[DataFrame], None] = lambda sales: None) -> DataFrame:
    """Replace the entries of the landing days in ``reloaded`` by ``deliveries`` (a refund feed with landing_day)
    and merge what that changes into the totals of the sales.  ``refund_ids`` names every refund that differs; returns the
    sales whose refunds changed (one column), which ``before_commit`` sees before anything is replaced."""
    spark, numbers = deliveries.sparkSession, buckets_of(refund_ids)
    ids = refund_ids.distinct()
    old = _deliveries(spark, path, numbers)
    mine = (deliveries.select(*C.MKT_REFUNDS.fieldNames(), "landing_day").withColumn("refund_amount", F.col("refund_amount").cast(_TOTAL))
            .withColumn("is_total", F.lit(False)).withColumn("refunds", F.lit(None).cast("long"))
            .withColumn("bucket", bucket("refund_id")).filter(within(numbers)(F.col("bucket"))).select(*REFUNDS.fieldNames()))
    kept = old.filter(~F.coalesce(reloaded(F.col("landing_day")), F.lit(False)))
    now = _staged(kept.unionByName(mine), "refund-entries")
    change = _staged(_charged(now.join(ids, "refund_id", "left_semi"), 1).unionByName(
        _charged(old.join(ids, "refund_id", "left_semi"), -1)).groupBy("original_transaction_id").agg(
        F.sum("refund_amount").cast(_TOTAL).alias("refund_amount"), F.sum("refunds").alias("refunds")), "refund-change")
    sales = change.select("original_transaction_id")
    before_commit(sales)

    both = sorted({*numbers, *buckets_of(sales)})
    others = _deliveries(spark, path, [b for b in both if b not in numbers])
    totals = (slices.read(spark, path, "bucket", REFUNDS, within(both)).filter("is_total")
              .select("original_transaction_id", "refund_amount", "refunds").unionByName(change)
              .groupBy("original_transaction_id").agg(F.sum("refund_amount").cast(_TOTAL).alias("refund_amount"),
                                                      F.sum("refunds").alias("refunds")).filter("refunds != 0")
              .withColumn("is_total", F.lit(True)).withColumn("bucket", bucket("original_transaction_id")))
    rows = now.unionByName(others).unionByName(totals, allowMissingColumns=True)
    slices.replace(rows.select(*REFUNDS.fieldNames()), path, "bucket", within(both))
    return sales
