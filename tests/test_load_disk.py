"""What a load leaves on disk: packed landing files and tables, no shuffle files of steps that have ended, and no shuffle of
rows that need none."""

import datetime as dt
import glob

from pyspark.sql import functions as F
from seed import feeds as seed_feeds

from martlake import contracts as C
from martlake.operators import key_index, refunds
from martlake.plans import runner
from martlake.session import scratch_path
from martlake.sinks import files as sinks
from martlake.sources import files as sources

AS_OF = dt.datetime(2026, 8, 23)
DAYS = [dt.date(2026, 8, d) for d in (19, 20, 21, 22)]


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(i).getName().startswith("shuffle_") for i in range(files.size()))


def test_a_load_leaves_no_shuffle_files_and_packed_tables(spark):
    layout, before = runner.Layout(scratch_path(spark, "disk")), shuffle_files(spark)
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    held = spark.conf.get(key, None)
    runner.land(seed_feeds(spark), layout)
    runner.run_range(spark, layout, DAYS[0], DAYS[-1] + dt.timedelta(days=1), AS_OF)
    assert shuffle_files(spark) - before < 20  # a few lookups of bucket numbers at most
    assert spark.conf.get(key, None) == held
    for feed in ("orders", "products", "sales", "refunds"):
        found = [f for f in glob.glob(f"{layout.root}/landing_{feed}/**/part-*", recursive=True)]
        assert found and all(f.endswith(".gz") for f in found), feed
    for table in ("staged_orders", "sale_index", "curated_sales", "fact_sales"):
        found = glob.glob(f"{layout.root}/{table}/data/*/*.parquet")
        assert found and all(f.endswith(".zstd.parquet") for f in found), table


def test_packed_and_plain_landing_files_read_alike(spark):
    f, path = seed_feeds(spark), scratch_path(spark, "landing")
    for packed, plain in (("gzip", None), (None, "gzip")):
        root = f"{path}/{packed}"
        early = F.col("created_at") < F.lit("2026-08-21").cast("timestamp_ntz")
        sinks.write_csv_landing(f.orders.filter(early), f"{root}/orders", day_of="created_at", compression=packed)
        sinks.write_csv_landing(f.orders.filter(~early), f"{root}/orders", day_of="created_at", compression=plain)
        want = f.orders.filter("created_at IS NOT NULL").withColumn("day", F.to_date("created_at"))
        got = sources.read_dated_feed(spark, f"{root}/orders", C.ORDERS, "csv").drop(sources.PARSE_ERRORS)
        assert rows(got) == rows(want.select(*C.ORDERS.fieldNames(), "day"))
        sinks.write_ndjson_landing(f.sales, f"{root}/sales", day_of="transaction_date", compression=packed)
        got = sources.read_ndjson_feed(spark, f"{root}/sales", C.MKT_SALES).drop(sources.PARSE_ERRORS)
        assert rows(got.select("transaction_id", "amount")) == rows(f.sales.select("transaction_id", "amount"))


def test_sales_without_a_refund_are_settled_where_they_are(spark):
    sales = spark.range(1000).select(F.concat(F.lit("S"), F.col("id")).alias("sale_id"), F.lit(1).cast(C.MONEY).alias("sales_amount"),
                                     F.lit(2).cast(C.MONEY).alias("rule_refund"))
    path = scratch_path(spark, "sales")
    sales.write.parquet(path)
    sales = spark.read.parquet(path).union(sales.limit(1).withColumn("sale_id", F.lit(None).cast("string")))
    totals = spark.createDataFrame([("S7", 3), ("S8", None), ("S7000", 1)], "original_transaction_id string, n int").select(
        "original_transaction_id", F.col("n").cast(C.MONEY).alias("_refunded"))
    want = rows(refunds.settle_totals(sales, totals))
    got = runner.settled_sales(sales, totals)
    assert rows(got) == want and len(want) == 1001
    few, rest = key_index.halves(sales, "sale_id", totals.select(key_index.hashed("original_transaction_id")))
    assert rows(few.select("sale_id")) == [("S7",), ("S8",)] and rest.count() == 999
    assert "Exchange hashpartitioning" not in rest._jdf.queryExecution().executedPlan().toString()
    # too many to broadcast: the totals are joined as before
    key = "spark.sql.autoBroadcastJoinThreshold"
    held = spark.conf.get(key)
    try:
        spark.conf.set(key, "16")
        assert key_index.halves(sales, "sale_id", totals.select(key_index.hashed("original_transaction_id"))) is None
        assert rows(runner.settled_sales(sales, totals)) == want
    finally:
        spark.conf.set(key, held)


def test_index_tells_sales_on_several_dates_in_the_shuffle_of_its_entries(spark, monkeypatch):
    from martlake.sinks import slices
    path, plans, replace = scratch_path(spark, "sale_index"), [], slices.replace

    def seen(df, *args, **more):
        plans.append(df._jdf.queryExecution().sparkPlan().toString())
        return replace(df, *args, **more)

    monkeypatch.setattr(slices, "replace", seen)
    day = [dt.date(2026, 8, d) for d in range(1, 6)]
    at = [dt.datetime(2026, 8, d, 9) for d in range(1, 6)]

    def put(k, deliveries):
        df = spark.createDataFrame([(s, d, t, day[k]) for s, d, t in deliveries],
                                   "sale_id string, sale_date date, newest timestamp_ntz, landing_day date")
        key_index.update_sales(df, path, ids, lambda c: c == F.lit(day[k]))

    ids = spark.createDataFrame([(f"S{k}",) for k in range(40)] + [(None,)], "sale_id string")
    for parts in ("4", "1024"):
        held = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            put(0, [(f"S{k}", day[0], at[0]) for k in range(40)] + [("S1", day[0], at[1])])
            put(1, [("S1", day[1], at[3]), ("S1", day[1], at[2]), ("S2", day[0], at[0]), ("S3", None, None), (None, day[0], at[0]),
                    (None, day[1], at[1])])
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", held)
        assert rows(key_index.moved_sales(spark, path)) == [("S1", at[3]), (None, at[1])]
        entries = {(r.sale_id, r.sale_date, r.landing_day): r.newest for r in key_index.sale_entries(spark, path).collect()}
        assert len(entries) == 45 and key_index.sale_entries(spark, path).count() == 45
        assert entries["S1", day[0], day[0]] == at[1] and entries["S1", day[1], day[1]] == at[3]
    put(1, [])
    assert key_index.moved_sales(spark, path).count() == 0 and key_index.sale_entries(spark, path).count() == 40
    assert all("RebalancePartitions" not in p and "REBALANCE" not in p for p in plans)
