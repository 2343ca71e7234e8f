"""Edge cases: dirty values, malformed lines, missing feeds, shoppers on two
marketplaces, orphan keys, single-digit months."""

import datetime as dt
import os
from decimal import Decimal

from pyspark.sql import functions as F

from martlake import contracts as C
from martlake.functions import scalars as S
from martlake.operators import conform, facts, quality, unify
from martlake.plans import flows
from martlake.session import scratch_path
from martlake.sinks import files as sinks
from martlake.sources import files as sources
from martlake.sources.files import PARSE_ERRORS


def test_name_split_one_two_three_words(spark):
    df = spark.createDataFrame([("Cher",), ("Jane Smith",), ("Anna Maria Lopez",), (None,)], "n string")
    got = [(r.f, r.l) for r in df.select(S.first_name("n").alias("f"), S.last_name("n").alias("l")).collect()]
    assert got == [("Cher", ""), ("Jane", "Smith"), ("Anna", "Maria"), (None, "")]


def test_parse_timestamp_rejects_garbage_without_failing(spark):
    df = spark.createDataFrame([("2026-08-09 10:30:00",), ("garbage",), ("2026-02-30 10:00:00",), (None,),
                                ("2026-08-09 10:30:00.25",)], "s string")
    got = [r.t for r in df.select(S.parse_timestamp("s").alias("t")).collect()]
    assert got == [dt.datetime(2026, 8, 9, 10, 30), None, None, None, dt.datetime(2026, 8, 9, 10, 30, 0, 250000)]


def test_identity_md5_is_60_bit_and_murmur_never_overflows(spark):
    df = spark.range(2000).select(F.concat(F.lit("u"), F.col("id"), F.lit("@x.com")).alias("e"))
    r = df.select(F.min(S.identity_md5("e")).alias("lo"), F.max(S.identity_md5("e")).alias("hi"),
                  F.min(S.identity_murmur("e")).alias("mlo"),
                  F.count_distinct(S.identity_md5("e")).alias("n")).first()
    assert r.lo >= 0 and r.hi < 2 ** 60 and r.mlo >= 0 and r.n == 2000


def test_csv_dirty_values_become_reasons(spark):
    path = scratch_path(spark, "orders_csv")
    os.makedirs(path)
    with open(f"{path}/orders.csv", "w") as fh:
        fh.write("order_id,customer_id,product_id,quantity,total_amount,order_status,created_at\n")
        fh.write("1,1,1,2,10.00,Completed,2026-08-09 10:00:00\n")
        fh.write("2,1,1,abc,10.00,Completed,2026-08-09 10:00:00\n")
        fh.write("3,1,1,,10.00,,2026-08-09 10:00:00\n")
        fh.write("4,1,1,0,10.00,Completed,not a date\n")
        fh.write("5,1,1,-1,10.00,Cancelled,\n")
    typed = sources.read_csv_feed(spark, path, C.ORDERS)
    c = quality.classify(typed, quality.web_order_rules(), PARSE_ERRORS)
    got = {r.order_id: list(r.reasons) for r in c.collect()}
    assert got == {
        1: [],
        2: ["bad_quantity", "null_quantity"],
        3: ["null_quantity", "null_status"],
        4: ["bad_created_at", "nonpositive_quantity"],  # the load drops the first: the landing day stands in
        5: ["nonpositive_quantity", "cancelled"],
    }
    # a valid order with no time takes the run's as_of
    ok = conform.web_sales(quality.valid(c), dt.datetime(2026, 8, 19)).collect()
    assert len(ok) == 1 and ok[0].transaction_date == dt.datetime(2026, 8, 9, 10)


def test_corrupt_json_line_is_quarantined(spark):
    path = scratch_path(spark, "sales_json")
    os.makedirs(f"{path}/year=2026/month=08/day=09")
    with open(f"{path}/year=2026/month=08/day=09/sales.json", "w") as fh:
        fh.write('{"transaction_id":"T1","marketplace_name":"Amazon","product_id":1,"quantity":1,'
                 '"amount":12.5,"customer_name":"A B","customer_email":"a@b.c",'
                 '"transaction_date":"2026-08-09 10:30:00"}\n')
        fh.write('{"transaction_id":"T2","marketplace_name":\n')
        fh.write('{"transaction_id":"T3","marketplace_name":"Amazon","product_id":1,"quantity":1,'
                 '"amount":1,"customer_email":"a@b.c","transaction_date":"yesterday"}\n')
    typed = sources.read_ndjson_feed(spark, path, C.MKT_SALES)
    c = quality.classify(typed, quality.mkt_sale_rules(), PARSE_ERRORS)
    rows = c.collect()
    assert len(rows) == 3
    by_id = {r.transaction_id: list(r.reasons) for r in rows}
    assert by_id["T1"] == [] and by_id[None][0] == "corrupt_record"
    assert by_id["T3"] == ["bad_transaction_date", "bad_timestamp"]
    assert [r.amount for r in rows if r.transaction_id == "T1"] == [Decimal("12.50")]


def test_missing_feed_falls_back_to_empty_contract(spark):
    df = sources.read_ndjson_feed(spark, scratch_path(spark, "nothing_here"), C.MKT_SALES)
    assert df.count() == 0
    assert [f.name for f in df.schema.fields][:-1] == [f.name for f in C.MKT_SALES.fields]


def test_shopper_on_two_marketplaces_is_two_customers(spark):
    from seed import feeds as seed_feeds
    f = seed_feeds(spark)
    extra = spark.createDataFrame([("X-1", 1, "john.doe@email.com", "John Doe", "Flipkart", 1, Decimal("5.00"),
                                    dt.datetime(2026, 8, 19, 12))], C.MKT_SALES)
    f.sales = f.sales.unionByName(extra)
    dc = flows.dim_customers(f)
    john = dc.filter("email = 'john.doe@email.com'").collect()
    assert sorted(r.source_system for r in john) == ["Amazon", "Flipkart"]
    fact = flows.fact_sales(spark, f, dt.datetime(2026, 8, 23))
    assert fact.filter("customer_key IS NULL").count() == 0


def test_orphan_keys_reported(spark):
    from seed import feeds as seed_feeds
    f = seed_feeds(spark)
    f.sales = f.sales.withColumn("product_id", F.when(F.col("marketplace_name") == "Flipkart", F.lit(99))
                                 .otherwise(F.col("product_id")))
    orphans = facts.orphans(flows.fact_sales(spark, f, dt.datetime(2026, 8, 23))).collect()
    assert len(orphans) == 4 and all(list(r.missing) == ["product"] for r in orphans)


def test_single_digit_month_and_day_slice(spark):
    path = scratch_path(spark, "by_date")
    df = spark.createDataFrame([("a", dt.date(2026, 8, 9)), ("b", dt.date(2026, 8, 10)),
                                ("c", dt.date(2026, 10, 9))], "id string, dt date")
    sinks.write_partitioned_parquet(df, path, ["dt"])
    got = sources.read_dated_slice(spark, path, dt.date(2026, 8, 9), dt.date(2026, 8, 10))
    assert [r.id for r in got.collect()] == ["a"]
    assert "PartitionFilters: [isnotnull(dt" in got._jdf.queryExecution().executedPlan().toString()


def test_pick_one_nulls_last_both_directions(spark):
    df = spark.createDataFrame([(1, None, "x"), (1, 5, "y"), (1, 3, "z")], "k int, v int, s string")
    hi = unify.pick_one(df, ["k"], ["v"], largest=True).first()
    lo = unify.pick_one(df, ["k"], ["v"], largest=False).first()
    assert (hi.v, hi.s) == (5, "y") and (lo.v, lo.s) == (3, "z")


def test_empty_extract_writes_nothing_and_reads_back_empty(spark):
    from seed import feeds as seed_feeds
    path = scratch_path(spark, "empty_orders")
    day = seed_feeds(spark).orders.filter("created_at >= TIMESTAMP_NTZ'2030-01-01 00:00:00'")
    assert sinks.write_csv_landing(day, path, skip_empty=True) is False
    assert not sources.path_exists(spark, path)
    assert sources.read_csv_feed(spark, path, C.ORDERS).count() == 0


def test_literal_case_product_source_leaves_marketplace_products_unmatched(spark):
    from seed import feeds as seed_feeds
    f = seed_feeds(spark)
    fact = flows.fact_sales(spark, f, dt.datetime(2026, 8, 23), product_source="case")
    by_channel = {r.channel_key: r.n for r in fact.filter("product_key IS NULL")
                  .groupBy("channel_key").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert by_channel == {2: 8, 3: 4}  # every marketplace sale; website sales all matched


def test_new_marketplace_gets_next_channel_key(spark):
    from martlake.operators import dimensions
    sales = spark.createDataFrame([("Amazon",), ("Meesho",), ("Etsy",), ("Meesho",), (None,)], "channel_name string")
    ch = {r.channel_name: (r.channel_key, r.channel_type) for r in dimensions.channels(spark, sales).collect()}
    assert ch["Website"] == (1, "Internal") and ch["Etsy"] == (4, "Marketplace") and ch["Meesho"] == (5, "Marketplace")
    assert len(ch) == 5


def test_dated_landing_reads_only_the_range_and_undated_rows(spark):
    from martlake.sources import fixtures
    path = scratch_path(spark, "landing_sales")
    s = fixtures.mkt_sales(spark, "/root/testdata/sf0.001")
    undated = s.agg(F.min("transaction_id")).first()[0]
    s = s.withColumn("transaction_date", F.when(F.col("transaction_id") == undated, F.lit(None))
                     .otherwise(F.col("transaction_date")))
    sinks.write_ndjson_landing(sinks.with_dated_keys(s, "transaction_date"), path, ["year", "month", "day"])
    got = sources.read_dated_ndjson_feed(spark, path, C.MKT_SALES, dt.date(2024, 1, 8), dt.date(2024, 1, 15))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(isnull(year" in plan
    rows = got.select("transaction_id", "transaction_date").collect()
    assert any(r.transaction_id == undated and r.transaction_date is None for r in rows)
    dated = [r.transaction_date for r in rows if r.transaction_date is not None]
    assert dated and all(dt.datetime(2024, 1, 8) <= t < dt.datetime(2024, 1, 15) for t in dated)
    assert len(dated) == s.filter("transaction_date >= TIMESTAMP_NTZ'2024-01-08 00:00:00' AND "
                                  "transaction_date < TIMESTAMP_NTZ'2024-01-15 00:00:00'").count()


def test_jdbc_options_prefer_explicit_values(monkeypatch):
    from martlake.sources import extract
    monkeypatch.setenv("JDBC_URL", "jdbc:x:y")
    monkeypatch.setenv("JDBC_PASSWORD", "secret")
    opts = extract.jdbc_options(user="me", fetchsize="5")
    assert opts == {"url": "jdbc:x:y", "user": "me", "password": "secret", "fetchsize": "5"}
    monkeypatch.delenv("JDBC_URL")
    assert extract.jdbc_options()["url"] == ""


def test_a_cluster_session_without_a_shared_folder_raises():
    from types import SimpleNamespace

    import pytest
    from martlake.session import shared_root
    spark = SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None),
                            sparkContext=SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_root(spark)
