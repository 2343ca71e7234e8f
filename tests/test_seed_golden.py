"""Golden values on the operational seed and the marketplace mock."""

import datetime as dt

from pyspark.sql import functions as F

from martlake.operators import dimensions, quality
from martlake.plans import flows
from seed import feeds as seed_feeds

AS_OF = dt.datetime(2026, 8, 23)


def _revenue(spark, refund_rule):
    f = seed_feeds(spark)
    r = flows.channel_revenue(flows.settled_sales(f, AS_OF, refund_rule), dimensions.channel_seed(spark))
    return {row.channel_name: tuple(row)[1:] for row in r.collect()}


def test_web_orders_split_per_day(spark):
    c = flows.classified_orders(seed_feeds(spark))
    per_day = {r.d: (r.valid, r.bad) for r in c.groupBy(F.to_date("created_at").cast("string").alias("d"))
               .agg(F.count_if(F.size("reasons") == 0).alias("valid"),
                    F.count_if(F.size("reasons") > 0).alias("bad")).collect()}
    assert per_day == {"2026-08-19": (4, 1), "2026-08-20": (3, 1), "2026-08-21": (4, 0), "2026-08-22": (3, 0)}
    bad = {r.order_id: list(r.reasons) for r in quality.quarantined(c).collect()}
    assert bad == {1099: ["cancelled"], 1007: ["cancelled"]}


def test_channel_revenue_feed_refunds_only(spark):
    got = _revenue(spark, refund_rule=False)
    assert got["Website"] == (14, 19, 9250.0, 0.0, 9250.0)
    assert got["Amazon"] == (8, 8, 5400.0, 600.0, 4800.0)
    assert got["Flipkart"] == (4, 8, 2000.0, 0.0, 2000.0)


def test_channel_revenue_with_web_refund_rule(spark):
    got = _revenue(spark, refund_rule=True)
    assert got["Website"] == (14, 19, 9250.0, 950.0, 8300.0)
    assert got["Amazon"] == (8, 8, 5400.0, 600.0, 4800.0)


def test_revenue_is_ordered_by_net_desc(spark):
    f = seed_feeds(spark)
    r = flows.channel_revenue(flows.settled_sales(f, AS_OF), dimensions.channel_seed(spark)).collect()
    assert [x.channel_name for x in r] == ["Website", "Amazon", "Flipkart"]


def test_dimension_sizes_and_fact_keys(spark):
    f = seed_feeds(spark)
    dp, dc = flows.dim_products(f), flows.dim_customers(f)
    assert dp.count() == 5
    assert dc.count() == 13
    assert sorted(r.source_system for r in dc.filter("source_system <> 'MySQL'").collect()) == \
        ["Amazon", "Amazon", "Flipkart"]
    fact = flows.fact_sales(spark, f, AS_OF, dims=(dp, dc))
    assert fact.count() == 26
    assert fact.filter("product_key IS NULL OR customer_key IS NULL OR channel_key IS NULL").count() == 0
    keys = sorted(r.product_key for r in dp.collect())
    assert keys == [1, 2, 3, 4, 5]


def test_marketplace_names_split(spark):
    from martlake.operators import conform
    f = seed_feeds(spark)
    mc = conform.marketplace_customers(quality.valid(flows.classified_sales(f))).distinct()
    names = {(r.first_name, r.last_name) for r in mc.collect()}
    assert names == {("John", "Doe"), ("Jane", "Smith"), ("Bob", "Johnson")}
