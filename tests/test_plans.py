"""Plan shape: no Python in the hot path, pruned scans, partial aggregation
for dedup (no window over a hot key), pushed partition filters."""

import datetime as dt

from pyspark.sql import functions as F

from martlake.operators import dimensions, unify
from martlake.plans import flows
from martlake.plans.catalog import QUERIES


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_udf_in_any_registered_plan(spark, sf_dir):
    for name in QUERIES:
        if name.startswith(("load_", "fact_", "merge_", "src_", "snk_", "stage_", "incremental", "contract_", "dim_keys")):
            continue  # these write and read back; their steps are the other queries'
        p = _plan(QUERIES[name](spark, sf_dir))
        assert "PythonUDF" not in p and "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_validity_is_generated_code_and_reaches_the_scan(spark, sf_dir):
    f = flows.feeds_from_tables(spark, sf_dir)
    for df, column in ((flows.valid_orders(f), "o_custkey"), (flows.valid_sales(f), "event_id")):
        plan = df._jdf.queryExecution().executedPlan()
        final = plan.initialPlan() if "Adaptive" in plan.nodeName() else plan
        assert "size(" not in final.toString() and f"IsNotNull({column})" in final.toString()


def test_scans_read_only_needed_columns(spark, sf_dir):
    p = QUERIES["channel_revenue"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "l_tax" not in p and "l_shipdate" not in p and "o_totalprice" not in p and "props" not in p


def test_dedup_is_partial_plus_final_aggregate_without_window(spark, sf_dir):
    d = unify.dedup_sales(flows.unified_sales(flows.feeds_from_tables(spark, sf_dir)))
    p = d._jdf.queryExecution().sparkPlan().toString()
    assert "partial_max" in p and "Window" not in p


def test_flagship_aggregates_before_joining_channels(spark, sf_dir):
    f = flows.feeds_from_tables(spark, sf_dir)
    r = flows.channel_revenue(flows.settled_sales(f), dimensions.channel_seed(spark))
    p = r._jdf.queryExecution().sparkPlan().toString()
    assert p.index("BroadcastHashJoin") < p.rindex("HashAggregate")


def test_day_extract_is_a_pushed_range(spark, sf_dir):
    from martlake.sources import extract, fixtures
    o = extract.day_extract(fixtures.table(spark, sf_dir, "orders").withColumnRenamed("o_orderdate", "created_at")
                            .withColumnRenamed("o_orderkey", "order_id").withColumnRenamed("o_custkey", "customer_id")
                            .selectExpr("*", "1 AS product_id", "1 AS quantity", "o_totalprice AS total_amount",
                                        "o_orderstatus AS order_status"),
                            dt.date(1996, 1, 1))
    p = _plan(o)
    assert "PushedFilters" in p and "GreaterThanOrEqual(o_orderdate" in p and "LessThan(o_orderdate" in p


def test_revenue_summary_reads_settled_sales_and_fact_from_what_was_written(spark, sf_dir, monkeypatch):
    from martlake.operators import summaries
    read, replace = [], summaries.replace

    def seen(fact, path, dates):
        read.append({f.split("/")[-2] if "/part-" in f else f.split("/")[-1] for f in fact.inputFiles()})
        replace(fact, path, dates)

    monkeypatch.setattr(summaries, "replace", seen)
    rows = QUERIES["summary_channel_revenue"](spark, sf_dir).collect()
    assert len(read) == 3 and not any("lineitem.parquet" in r for r in read)
    assert "settled_sales" in read[0] and read[1] == read[2] == {"fact_sales"}
    assert [tuple(r) for r in rows] == [tuple(r) for r in QUERIES["fact_channel_revenue"](spark, sf_dir).collect()]


def test_a_sale_without_a_time_is_picked_again_with_the_runs_time(spark):
    """An order delivered with and without a time: as settled_sales with as_of, only that sale anew."""
    import dataclasses

    from seed import feeds as seed_feeds
    as_of, f = dt.datetime(2026, 8, 23), seed_feeds(spark)
    some = f.orders.limit(3).withColumn("created_at", F.lit(None).cast("timestamp_ntz")).withColumn("total_amount", F.col("total_amount") + 1)
    f = dataclasses.replace(f, orders=unify.union_all(f.orders, some.withColumn("total_amount", F.col("total_amount").cast("decimal(10,2)"))))
    plain = flows.settled_sales(f, refund_rule=True)
    want = flows.settled_sales(f, as_of, refund_rule=True)
    got = flows.redated(plain, f, flows.valid_refunds(f), as_of)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert got.exceptAll(plain).count() > 0
