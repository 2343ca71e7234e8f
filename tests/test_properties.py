"""Properties on the benchmark tables: totals, determinism, key stability,
idempotent reruns, batch = incremental."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from martlake import contracts as C
from martlake.functions import scalars as S
from martlake.operators import dimensions, quality, unify
from martlake.plans import flows, runner
from martlake.plans.catalog import AS_OF, FULL_RANGE, QUERIES
from martlake.session import scratch_path
from martlake.sinks import files as sinks
from martlake.sinks import slices
from martlake.sources import files as sources
from martlake.sources import fixtures
from martlake.streaming import incremental


def test_split_is_total_and_matches_expected_counts(spark, sf_dir):
    f = flows.feeds_from_tables(spark, sf_dir)
    co, cs = flows.classified_orders(f), flows.classified_sales(f)
    n, v, q = co.count(), quality.valid(co).count(), quality.quarantined(co).count()
    assert (n, v) == (6000, 4480) and v + q == n
    n, v, q = cs.count(), quality.valid(cs).count(), quality.quarantined(cs).count()
    assert (n, v) == (412, 338) and v + q == n
    assert f.refunds.count() == 41
    # rows the two hand-written filters of the source system both miss are caught
    assert co.filter(F.array_contains("reasons", "null_status")).count() == 918


def test_customer_grain_counts(spark, sf_dir):
    f = flows.feeds_from_tables(spark, sf_dir)
    mkt = flows.unified_customers(f).filter("source_system <> 'MySQL'")
    assert mkt.select("email").distinct().count() == 14
    assert mkt.select("email", "source_system").distinct().count() == 28


def test_dedup_independent_of_input_order(spark, sf_dir):
    u = flows.unified_sales(flows.feeds_from_tables(spark, sf_dir))
    a = unify.dedup_sales(u)
    b = unify.dedup_sales(u.repartition(7).orderBy(F.rand(5)))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert a.count() == a.select("sale_id").distinct().count()


def test_assign_keys_dense_and_ordered(spark, sf_dir):
    df = fixtures.web_customers(spark, sf_dir).select("customer_id", F.lit("MySQL").alias("source_system"))
    keyed = dimensions.assign_keys(df, ["customer_id", "source_system"], "k", start_after=100,
                                   num_partitions=5)
    rows = sorted((r.customer_id, r.k) for r in keyed.collect())
    assert [k for _, k in rows] == list(range(101, 101 + len(rows)))


def test_scd1_keys_stable_and_new_members_appended(spark, sf_dir):
    key, nat = C.DIM_PRODUCTS_KEY
    cp = flows.curated_products(flows.feeds_from_tables(spark, sf_dir))
    first = dimensions.scd1_upsert(None, cp.filter("product_id < 100"), key, nat, "product_name")
    path = scratch_path(spark, "dim")
    dimensions.write_version(first, path)
    changed = cp.withColumn("price", F.col("price") + F.lit(1).cast(C.MONEY))
    second = dimensions.scd1_upsert(dimensions.read_latest(spark, path), changed, key, nat, "product_name")
    old = {r.product_id: r.product_key for r in first.collect()}
    new = {r.product_id: (r.product_key, r.price) for r in second.collect()}
    assert all(new[p][0] == k for p, k in old.items())
    assert sorted(k for p, (k, _) in new.items() if p not in old) == list(range(len(old) + 1, len(new) + 1))
    prices = {r.product_id: r.price for r in cp.collect()}
    assert all(new[p][1] == prices[p] + 1 for p in new)
    # the same incoming twice changes nothing
    dimensions.write_version(second, path)
    third = dimensions.scd1_upsert(dimensions.read_latest(spark, path), changed, key, nat, "product_name")
    assert third.exceptAll(second).count() == 0


def test_rerun_equals_single_run(spark, sf_dir):
    layout = runner.Layout(scratch_path(spark, "lh"))
    runner.land(flows.feeds_from_tables(spark, sf_dir), layout)
    metrics = runner.run_range(spark, layout, *FULL_RANGE, as_of=AS_OF)
    assert metrics["orders"] == {"n_input": 6000, "n_valid": 4480, "n_quarantined": 1520}
    once = runner.read_fact(spark, layout).drop("ingestion_timestamp").collect()
    dims_once = [sorted(map(tuple, dimensions.read_latest(spark, getattr(layout, d)).collect()))
                 for d in ("dim_products", "dim_customers", "dim_channels")]
    runner.run_range(spark, layout, *FULL_RANGE, as_of=AS_OF)
    twice = runner.read_fact(spark, layout).drop("ingestion_timestamp").collect()
    assert sorted(map(tuple, once)) == sorted(map(tuple, twice))
    dims_twice = [sorted(map(tuple, dimensions.read_latest(spark, getattr(layout, d)).collect()))
                  for d in ("dim_products", "dim_customers", "dim_channels")]
    assert dims_once == dims_twice
    assert len(once) == len({r.sale_id for r in once})
    assert runner.read_quarantine(spark, layout, "orders").count() == 6000 - 4480
    # the published query over the loaded star schema equals the flow's revenue
    star = flows.fact_channel_revenue(runner.read_fact(spark, layout), dimensions.channel_seed(spark))
    direct = QUERIES["channel_revenue_web_refunds"](spark, sf_dir)
    assert [tuple(r) for r in star.collect()] == [tuple(r) for r in direct.collect()]


def test_replace_slices_clears_emptied_dates(spark):
    rows = [("a", dt.date(2024, 1, 1)), ("b", dt.date(2024, 1, 2)), ("c", dt.date(2024, 1, 3))]
    df = spark.createDataFrame(rows, "sale_id string, sale_date date")
    path = scratch_path(spark, "fact")
    slices.replace(df, path, "sale_date", slices.between(dt.date(2024, 1, 1), dt.date(2024, 1, 4)))
    # the new slice of 2 and 3 only has a row for the 3rd: the 2nd must go
    slices.replace(df.filter("sale_id = 'c'"), path, "sale_date", slices.between(dt.date(2024, 1, 2), dt.date(2024, 1, 4)))
    got = sorted((r.sale_id, r.sale_date) for r in slices.read(spark, path, "sale_date").collect())
    assert got == [("a", dt.date(2024, 1, 1)), ("c", dt.date(2024, 1, 3))]
    # rows without a date are one slice, replaced in place; a date's reader opens its folder only
    undated = df.withColumn("sale_date", F.lit(None).cast("date")).limit(1)
    for _ in range(3):
        slices.replace(undated, path, "sale_date", lambda day: day.isNull())
    assert slices.read(spark, path, "sale_date").count() == 3
    one = slices.read(spark, path, "sale_date", where=lambda day: day == dt.date(2024, 1, 1))
    assert [r.sale_id for r in one.collect()] == ["a"] and sum("/data/" in f for f in one.inputFiles()) == 1


def test_batch_equals_incremental(spark, sf_dir):
    got = QUERIES["incremental_sales"](spark, sf_dir)
    batch = QUERIES["conform_sales"](spark, sf_dir).withColumn(
        "transaction_date", F.concat(F.substring("transaction_date", 1, 19), F.lit(".000000")))
    assert got.exceptAll(batch).count() == 0 and batch.exceptAll(got).count() == 0


def test_incremental_picks_up_only_new_files(spark, sf_dir):
    root = scratch_path(spark, "inc")
    s = fixtures.mkt_sales(spark, sf_dir).withColumn("dt", F.to_date("transaction_date"))
    sinks.write_ndjson_landing(s.filter("dt < DATE'2024-01-10'"), f"{root}/landing", ["dt"])
    incremental.run_available_now(spark, f"{root}/landing", f"{root}/ck", f"{root}/cur")
    n1 = spark.read.parquet(f"{root}/cur").count()
    incremental.run_available_now(spark, f"{root}/landing", f"{root}/ck", f"{root}/cur")
    assert spark.read.parquet(f"{root}/cur").count() == n1  # nothing new, nothing added
    sinks.write_ndjson_landing(s.filter("dt >= DATE'2024-01-10'"), f"{root}/landing", ["dt"])
    incremental.run_available_now(spark, f"{root}/landing", f"{root}/ck", f"{root}/cur")
    c = flows.classified_sales(flows.feeds_from_tables(spark, sf_dir))
    total = quality.valid(c).count()
    assert spark.read.parquet(f"{root}/cur").count() == total > n1
    # nothing is dropped: the rest is in the quarantine with its reasons
    assert incremental.read_quarantine(spark, f"{root}/cur").count() == quality.quarantined(c).count() > 0
    # another checkpoint starts at epoch 0 again and overwrites nothing
    incremental.run_available_now(spark, f"{root}/landing", f"{root}/ck2", f"{root}/cur")
    assert spark.read.parquet(f"{root}/cur").count() == 2 * total
    assert incremental.read_curated(spark, f"{root}/cur").count() == total


def test_late_refund_updates_its_sales_older_slice(spark):
    """A refund landing days after its sale re-slices the sale's date, which
    keeps the refunds it already had."""
    from decimal import Decimal
    from seed import feeds as seed_feeds
    f = seed_feeds(spark)
    layout = runner.Layout(scratch_path(spark, "late"))
    runner.land(f, layout)
    runner.run_range(spark, layout, dt.date(2026, 8, 19), dt.date(2026, 8, 23), dt.datetime(2026, 8, 19))
    late = spark.createDataFrame([("R-LATE", "MKT-SALE-FLP-2026-08-19-102", Decimal("100.00"), "x@y.z",
                                   dt.datetime(2026, 8, 25, 9))], C.MKT_REFUNDS)
    sinks.write_ndjson_landing(sinks.with_dated_keys(late, "refund_date"), layout.landing_refunds,
                               ["year", "month", "day"])
    runner.run_range(spark, layout, dt.date(2026, 8, 25), dt.date(2026, 8, 26), dt.datetime(2026, 8, 25))
    fact = {r.sale_id: r.refund_amount for r in runner.read_fact(spark, layout).collect()}
    assert fact["MKT-SALE-FLP-2026-08-19-102"] == Decimal("100.00")
    assert fact["MKT-SALE-AMZ-2026-08-19-103"] == Decimal("150.00")  # its own refund is kept
    assert len(fact) == 26


def test_order_without_time_takes_its_landing_day_once(spark):
    from seed import feeds as seed_feeds
    f = seed_feeds(spark)
    layout = runner.Layout(scratch_path(spark, "undated"))
    runner.land(f, layout)
    # order 1001 arrives in the 2026-08-19 folder with an empty time; a
    # stray order with no time and no folder date is quarantined
    keyed = sinks.with_dated_keys(f.orders, "created_at").withColumn(
        "created_at", F.when(F.col("order_id") == 1001, F.lit(None)).otherwise(F.col("created_at")))
    sinks.write_csv_landing(keyed, layout.landing_orders, ["year", "month", "day"])
    stray = f.orders.filter("order_id = 1002").withColumn("order_id", F.lit(2002).cast("bigint")) \
        .withColumn("created_at", F.lit(None).cast("timestamp_ntz"))
    sinks.write_csv_landing(sinks.with_dated_keys(stray, "created_at"), layout.landing_orders,
                            ["year", "month", "day"])
    for day in range(19, 23):
        runner.main(["--root", layout.root, "--start", dt.date(2026, 8, day).isoformat()])
    fact = runner.read_fact(spark, layout)
    got = fact.filter("sale_id = 'MYSQL-ORDER-1001'").collect()
    assert len(got) == 1 and got[0].sale_date == dt.date(2026, 8, 19)
    assert fact.count() == 26 and fact.filter("sale_id = 'MYSQL-ORDER-2002'").count() == 0
    q = runner.read_quarantine(spark, layout, "orders").filter("order_id = 2002").collect()
    assert len(q) == 1 and list(q[0].reasons) == ["undated"]  # once, after four runs


def test_channel_keys_stable_across_runs(spark):
    from martlake.operators import dimensions
    path = scratch_path(spark, "dim_channels")
    run1 = spark.createDataFrame([("Website",), ("Meesho",)], "channel_name string")
    run2 = spark.createDataFrame([("Etsy",), ("Meesho",), ("Amazon",)], "channel_name string")
    first = {r.channel_name: r.channel_key for r in dimensions.upsert_channels(spark, path, run1).collect()}
    second = {r.channel_name: r.channel_key for r in dimensions.upsert_channels(spark, path, run2).collect()}
    assert first["Meesho"] == second["Meesho"] == 4 and second["Etsy"] == 5
    third = dimensions.upsert_channels(spark, path, run1)
    assert dimensions.committed_versions(spark, path) == [1, 2] and third.count() == 5


def test_submit_entry_loads_one_day(spark):
    from seed import feeds as seed_feeds
    layout = runner.Layout(scratch_path(spark, "submit"))
    runner.land(seed_feeds(spark), layout)
    metrics = runner.main(["--root", layout.root, "--start", "2026-08-19"])
    assert metrics["orders"] == {"n_input": 5, "n_valid": 4, "n_quarantined": 1}
    fact = runner.read_fact(spark, layout)
    assert fact.count() == 7 and {r.sale_date for r in fact.select("sale_date").distinct().collect()} == \
        {dt.date(2026, 8, 19)}


def test_late_arriving_sale_joins_its_event_day(spark):
    from seed import feeds as seed_feeds
    f = seed_feeds(spark)
    layout = runner.Layout(scratch_path(spark, "late_arrival"))
    runner.land(f, layout)
    for day in (19, 20, 21):
        runner.main(["--root", layout.root, "--start", dt.date(2026, 8, day).isoformat()])
    # a sale of the 19th that arrives in the 22nd's folder
    late = (f.sales.filter("transaction_id = 'MKT-SALE-AMZ-2026-08-19-101'")
            .withColumn("transaction_id", F.lit("MKT-LATE-1"))
            .withColumn("year", F.lit("2026")).withColumn("month", F.lit("08")).withColumn("day", F.lit("22")))
    day22 = sinks.with_dated_keys(f.sales, "transaction_date").filter("day = '22'")
    sinks.write_ndjson_landing(day22.unionByName(late), layout.landing_sales, ["year", "month", "day"])
    for _ in range(2):  # the rerun changes nothing
        runner.main(["--root", layout.root, "--start", "2026-08-22"])
        fact = runner.read_fact(spark, layout)
        assert fact.count() == 27
        assert fact.filter("sale_date = DATE'2026-08-19'").count() == 8
        got = fact.filter("sale_id = 'MKT-LATE-1'").collect()
        assert len(got) == 1 and got[0].sale_date == dt.date(2026, 8, 19)
    # nor does a rerun of its event day lose it
    runner.main(["--root", layout.root, "--start", "2026-08-19"])
    assert runner.read_fact(spark, layout).filter("sale_id = 'MKT-LATE-1'").count() == 1
    # the same sale delivered again with a later time moves to that day, and older ranges don't bring it back
    moved = late.withColumn("transaction_date", F.lit("2026-08-22 10:00:00").cast("timestamp_ntz"))
    sinks.write_ndjson_landing(day22.unionByName(moved), layout.landing_sales, ["year", "month", "day"])
    sinks.write_ndjson_landing(late.withColumn("day", F.lit("23")), layout.landing_sales, ["year", "month", "day"])
    for day in (22, 23, 19):
        runner.main(["--root", layout.root, "--start", dt.date(2026, 8, day).isoformat()])
        fact = runner.read_fact(spark, layout)
        assert fact.count() == 27 == fact.select("sale_id").distinct().count()
        assert fact.filter("sale_id = 'MKT-LATE-1'").first().sale_date == dt.date(2026, 8, 22)


def test_first_run_without_landed_data_is_a_no_op(spark):
    layout = runner.Layout(scratch_path(spark, "empty_root"))
    metrics = runner.main(["--root", layout.root, "--start", "2026-08-19"])
    none = {"n_input": 0, "n_valid": 0, "n_quarantined": 0}
    assert metrics == {"orders": none, "sales": none, "refunds": none}


def test_dirty_feeds_are_quarantined_and_harm_nothing(spark):
    """A refund delivered twice is charged once, also when dated before its
    sale's range; unreadable refunds and products are kept with reasons; the
    dimensions stay as they are over three runs."""
    from decimal import Decimal
    from seed import feeds as seed_feeds
    layout = runner.Layout(scratch_path(spark, "dirty"))
    runner.land(seed_feeds(spark), layout)
    sale = "MKT-SALE-FLP-2026-08-19-102"

    def drop(folder, name, *lines):
        os.makedirs(f"{layout.root}/{folder}", exist_ok=True)
        with open(f"{layout.root}/{folder}/{name}", "w") as fh:
            fh.write("\n".join(lines) + "\n")

    def refund(key, amount, time):
        return json.dumps({"refund_id": key, "original_transaction_id": sale, "refund_amount": amount,
                           "customer_email": "x@y.z", "refund_date": time})

    drop("landing_refunds/year=2026/month=8/day=19", "part-a.json", refund("R-1", "50.00", "2026-08-18 09:00:00"),
         refund("R-2", "12,50", "2026-08-19 09:00:00"), '{"refund_id": "R-3", "orig')
    drop("landing_refunds/year=2026/month=8/day=20", "part-b.json", refund("R-1", "50.00", "2026-08-20 09:00:00"))
    drop("landing_products", "part-c.csv", "product_id,product_name,category,price", "x9,Lamp,Home,12.00",
         "2,Lamp, big,Home,12.00", "1,Mouse,Home,abc")
    before = None
    for day in (19, 20, 19):
        runner.main(["--root", layout.root, "--start", dt.date(2026, 8, day).isoformat()])
        products = sorted(map(tuple, dimensions.read_latest(spark, layout.dim_products).collect()))
        assert before in (None, products) and len(products) == 5
        before = products
    fact = {r.sale_id: r.refund_amount for r in runner.read_fact(spark, layout).collect()}
    assert fact[sale] == Decimal("50.00")
    bad = {r.refund_id: list(r.reasons) for r in runner.read_quarantine(spark, layout, "refunds").collect()}
    assert bad["R-2"] == ["bad_refund_amount", "null_refund_amount"] and bad[None][0] == "corrupt_record"
    reasons = sorted(r.reasons[0] for r in runner.read_quarantine(spark, layout, "products").collect())
    assert reasons == ["bad_price", "bad_product_id", "corrupt_record"]


def test_day_folders_without_padding_are_read_by_any_range(spark):
    path = scratch_path(spark, "unpadded")
    os.makedirs(f"{path}/year=2026/month=8/day=9")
    with open(f"{path}/year=2026/month=8/day=9/a.json", "w") as fh:
        fh.write(json.dumps({"transaction_id": "T1", "transaction_date": "2026-08-09 10:00:00"}) + "\n")
    for end in (dt.date(2026, 8, 10), dt.date(2026, 11, 7)):
        got = sources.read_dated_ndjson_feed(spark, path, C.MKT_SALES, dt.date(2026, 8, 9), end)
        assert [r.transaction_id for r in got.collect()] == ["T1"]
    assert sources.read_dated_ndjson_feed(spark, path, C.MKT_SALES, dt.date(2026, 8, 10), dt.date(2026, 8, 11)).count() == 0
