"""Hot keys at test scale: AQE thresholds are shrunk so that the skew
handling of the plans engages on small data, as it would on large data."""

import contextlib
import os

from pyspark.sql import functions as F

from martlake.operators import unify
from martlake.session import scratch_path
from martlake.sinks import files as sinks


@contextlib.contextmanager
def conf(spark, **values):
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _hot(spark, n=30000):
    # a third of all rows on one date / one key
    return spark.range(n).select(
        F.concat(F.lit("S"), F.col("id")).alias("sale_id"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("customer_id"),
        F.when(F.col("id") % 3 == 0, F.lit("2024-01-01")).otherwise(
            F.date_format(F.date_add(F.lit("2024-01-01"), (F.col("id") % 40).cast("int")), "yyyy-MM-dd"))
        .cast("date").alias("sale_date"),
        (F.col("id") % 100).alias("amount"))


def test_hot_date_is_split_over_several_files(spark):
    path = scratch_path(spark, "hot")
    with conf(spark, **{"spark.sql.adaptive.advisoryPartitionSizeInBytes": "128k",
                        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k"}):
        sinks.write_partitioned_parquet(_hot(spark), path, ["sale_date"])
    def files(d):
        return len([f for f in os.listdir(f"{path}/{d}") if f.endswith(".parquet")])
    dates = [d for d in os.listdir(path) if d.startswith("sale_date=")]
    hot = files("sale_date=2024-01-01")
    # the hot date is split over several tasks; small dates are not
    assert hot > 1 and min(files(d) for d in dates) == 1
    assert spark.read.parquet(path).count() == 30000


def test_hot_key_dedup_is_exact(spark):
    df = _hot(spark).withColumn("sale_id", F.when(F.substring("sale_id", 2, 9).cast("int") % 3 == 0, F.lit("HOT"))
                                .otherwise(F.col("sale_id")))
    got = unify.pick_one(df, ["sale_id"], ["amount"], largest=True)
    hot = got.filter("sale_id = 'HOT'").collect()
    assert len(hot) == 1 and hot[0].amount == 99
    assert got.count() == 20001


def test_hot_customer_lookup_uses_skew_join_when_not_broadcast(spark):
    sales = _hot(spark).withColumn("source_system", F.lit("MySQL"))
    dim = spark.range(30000).select(F.col("id").alias("customer_id"), F.lit("MySQL").alias("source_system"),
                                   (F.col("id") + 1).alias("customer_key"))
    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1",
                        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
                        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
                        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
                        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k"}):
        j = sales.join(dim, ["customer_id", "source_system"], "left")
        assert len(j.collect()) == 30000  # runs this plan, so AQE finalises it
        plan = j._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin(skew=true)" in plan and "AQEShuffleRead skewed" in plan
