"""Loads that cost what the day costs: indexes of sales and refunds, broken-off runs, observed counts, and the stream
that ends in the fact."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from seed import feeds as seed_feeds

from martlake import contracts as C
from martlake.operators import dimensions, key_index, refunds
from martlake.plans import flows, runner
from martlake.session import scratch_path
from martlake.sinks import files as sinks
from martlake.sinks import slices
from martlake.streaming import incremental

AS_OF = dt.datetime(2026, 8, 23)
DAYS = [dt.date(2026, 8, d) for d in (19, 20, 21, 22)]
ONE = dt.timedelta(days=1)


def load(spark, layout, start, end=None):
    return runner.run_range(spark, layout, start, end or start + ONE, AS_OF)


def fact(spark, layout):
    return sorted(map(tuple, runner.read_fact(spark, layout).drop("ingestion_timestamp", "customer_key").collect()))


def folders(spark, path):
    return {r.day: r.folder for r in dimensions.read_latest(spark, f"{path}/manifest").collect()}


def land_late(spark, layout, day, **changes):
    """A sale of the 19th delivered on another day."""
    sale = seed_feeds(spark).sales.filter("transaction_id = 'MKT-SALE-AMZ-2026-08-19-101'")
    for column, value in changes.items():
        sale = sale.withColumn(column, F.lit(value).cast(sale.schema[column].dataType))
    keyed = sale.withColumns({"year": F.lit(f"{day:%Y}"), "month": F.lit(f"{day:%m}"), "day": F.lit(f"{day:%d}")})
    sinks.write_ndjson_landing(keyed, layout.landing_sales, ["year", "month", "day"])


def test_a_day_reads_its_own_slices_and_the_buckets_of_its_ids(spark):
    layout = runner.Layout(scratch_path(spark, "days"))
    runner.land(seed_feeds(spark), layout)
    for day in DAYS:
        load(spark, layout, day)
    land_late(spark, layout, dt.date(2026, 8, 23), amount="1300.00")
    before, buckets = folders(spark, layout.fact_sales), folders(spark, layout.sale_index)
    staged = folders(spark, layout.staged_orders)
    load(spark, layout, dt.date(2026, 8, 23))
    # of the fact only the sale's own date is written again, of the index only the sale's bucket
    after = folders(spark, layout.fact_sales)
    assert {d for d in after if after[d] != before.get(d)} == {DAYS[0]}
    changed = {b for b, f in folders(spark, layout.sale_index).items() if f != buckets.get(b)}
    assert changed == set(key_index.buckets_of(spark.createDataFrame([("MKT-SALE-AMZ-2026-08-19-101",)], "sale_id string")))
    # the rows rebuilt come from the slices of the days that hold them
    touched = lambda day: day.isin([DAYS[0]])
    rows = runner.all_sales(spark, layout, True, runner.days_holding(spark, layout, touched), touched)
    assert sum(staged[d] in f for d in DAYS for f in rows.inputFiles()) == sum(staged[DAYS[0]] in f for f in rows.inputFiles()) > 0
    got = {r.sale_id: r.sales_amount for r in runner.read_fact(spark, layout).collect()}
    assert got["MKT-SALE-AMZ-2026-08-19-101"] == Decimal("1300.00") and len(got) == len(fact(spark, layout))
    # the summary's revenue is the fact's, and reads no fact
    revenue = runner.read_revenue(spark, layout)
    assert not any("/fact_sales/" in f for f in revenue.inputFiles())
    star = flows.fact_channel_revenue(runner.read_fact(spark, layout), dimensions.channel_seed(spark))
    assert [tuple(r) for r in revenue.collect()] == [tuple(r) for r in star.collect()]


@pytest.mark.parametrize("step", ["update_refunds"])
def test_a_run_that_broke_off_is_made_good_by_the_next(spark, monkeypatch, step):
    layout = runner.Layout(scratch_path(spark, "broken"))
    runner.land(seed_feeds(spark), layout)
    load(spark, layout, DAYS[0], DAYS[-1] + ONE)
    # the 20th lands again: one sale is gone, another has moved to the 21st
    day = seed_feeds(spark).sales.filter("transaction_id LIKE '%08-20%' AND transaction_id NOT LIKE '%101'")
    moved = day.withColumn("transaction_date", F.expr("CASE WHEN transaction_id LIKE '%102' THEN TIMESTAMP_NTZ'2026-08-21 09:00:00' "
                                                      "ELSE transaction_date END"))
    keyed = moved.withColumns({"year": F.lit("2026"), "month": F.lit("08"), "day": F.lit("20")})
    sinks.write_ndjson_landing(keyed, layout.landing_sales, ["year", "month", "day"])

    def fails(*args, **more):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(key_index, step, fails)
        with pytest.raises(RuntimeError, match="lost"):
            load(spark, layout, DAYS[1])
    load(spark, layout, DAYS[3])  # another day
    again = runner.Layout(scratch_path(spark, "whole"))
    again_feeds = seed_feeds(spark)
    again_feeds.sales = again_feeds.sales.filter("transaction_id NOT LIKE '%08-20%'")
    runner.land(again_feeds, again)
    sinks.write_ndjson_landing(keyed, again.landing_sales, ["year", "month", "day"])
    load(spark, again, DAYS[0], DAYS[-1] + ONE)
    assert fact(spark, layout) == fact(spark, again)
    assert dimensions.read_latest(spark, layout.unfinished).count() == 0


def test_merged_refund_totals_equal_the_recomputation(spark):
    path = scratch_path(spark, "refund_index")
    at = dt.datetime(2026, 8, 20, 12)
    days = {
        1: [("R1", "S1", "10.00", 0), ("R2", "S1", "5.00", 0), ("R3", "S2", "7.00", 0)],
        2: [("R1", "S1", "12.00", 1), ("R3", "S3", "7.00", 2)],  # dearer; moved to another sale
        3: [("R4", "S2", "1.00", 0), ("R2", "S1", "4.00", -1)],  # late; delivered before, so it doesn't count
    }

    def frame(rows):
        return spark.createDataFrame([(r, s, Decimal(a), "x@y.z", at + dt.timedelta(hours=h)) for r, s, a, h in rows], C.MKT_REFUNDS)

    def put(day):
        ids = {r for rows in (days[day], held.get(day, [])) for r, *_ in rows}
        named = spark.createDataFrame([(i,) for i in sorted(ids)], "refund_id string")
        key_index.update_refunds(frame(days[day]).withColumn("landing_day", F.lit(dt.date(2026, 8, day))), path, named,
                                 lambda d, k=day: d == F.lit(dt.date(2026, 8, k)))
        held[day] = list(days[day])
        want = {r.original_transaction_id: r._refunded for r in refunds.refund_totals(
            frame([x for rows in held.values() for x in rows])).collect()}
        got = {r.original_transaction_id: r._refunded for r in key_index.refund_totals(spark, path).collect()}
        assert got == want

    held = {}
    for day in (1, 2, 3, 2):
        put(day)
    days[2] = []  # withdrawn: the first deliveries count again
    put(2)
    days[1] = [("R2", "S1", "5.00", 0)]
    put(1)
    days[1] = days[3] = []
    put(1)
    put(3)
    assert key_index.refund_totals(spark, path).count() == 0


def test_counts_are_observed_while_writing(spark):
    path = scratch_path(spark, "observed")
    rows = spark.range(100).select(F.when(F.col("id") % 10 > 0, F.date_add(F.lit("2026-08-01").cast("date"), (F.col("id") % 3).cast("int")))
                                   .alias("day"), (F.col("id") % 2 == 0).alias("ok"))
    counts = {"n": F.count(F.lit(1)), "ok": F.count_if("ok")}
    assert slices.replace(rows, path, "day", lambda d: F.lit(True), counts) == {"n": 100, "ok": 50}
    assert slices.replace(rows.limit(0), path, "day", lambda d: F.lit(True), counts) == {"n": 0, "ok": 0}
    assert slices.replace(rows, path, "day", lambda d: F.lit(True)) == {}


def test_only_buckets_with_a_change_are_written(spark):
    path, key, nat = scratch_path(spark, "dim"), "k", ["id", "src"]

    def rows(**names):
        return spark.createDataFrame([(k, "s", names.get(f"n{k}", f"name {k}"), None) for k in range(400)], "id long, src string, name string, note string")

    def current():
        return {r.id: (r.k, r.name) for r in dimensions.read_latest(spark, path).collect()}

    assert len(dimensions.upsert_buckets(spark, path, rows().filter("id < 390"), key, nat, "name")) > 100
    first, held = current(), folders(spark, path)
    assert sorted(k for k, _ in first.values()) == list(range(1, 391))
    assert dimensions.upsert_buckets(spark, path, rows().filter("id < 390"), key, nat, "name") == []  # says nothing new
    assert folders(spark, path) == held
    written = dimensions.upsert_buckets(spark, path, rows(n7="seven").filter("id < 392"), key, nat, "name")
    assert 1 <= len(written) <= 3 and {b for b, f in folders(spark, path).items() if f != held.get(b)} == set(written)
    now = current()
    assert now[7] == (first[7][0], "seven") and {now[k][0] for k in (390, 391)} == {391, 392}
    assert all(now[k] == first[k] for k in first if k != 7)
    # a member whose bucket held none so far
    taken = set(held) | set(written)
    free = spark.range(1000, 9000).select("id", F.pmod(F.xxhash64("id", F.lit("s")), F.lit(dimensions.BUCKETS)).alias("b")).filter(
        ~F.col("b").isin(sorted(taken))).first()
    if free is not None:
        new = spark.createDataFrame([(free.id, "s", "new", None)], "id long, src string, name string, note string")
        assert dimensions.upsert_buckets(spark, path, new, key, nat, "name") == [free.b] and current()[free.id] == (393, "new")


def test_stream_writes_the_fact_and_late_duplicates_only_their_slice(spark):
    layout = runner.Layout(scratch_path(spark, "stream"))
    f = seed_feeds(spark)
    sales, f.sales = f.sales, f.sales.limit(0)
    runner.land(f, layout)
    load(spark, layout, DAYS[0], DAYS[-1] + ONE)

    def pick_up():
        incremental.run_into_fact(spark, layout, f"{layout.root}/checkpoint", AS_OF)
        return folders(spark, layout.fact_sales)

    for day in DAYS[:2]:
        runner.land_sales(sales.filter(F.to_date("transaction_date") == F.lit(day)), layout)
        first = pick_up()
    runner.land_sales(sales.filter(F.to_date("transaction_date") > F.lit(DAYS[1])), layout)
    second = pick_up()
    assert {d for d in second if second[d] != first.get(d)} == set(DAYS[2:])
    batch = runner.Layout(scratch_path(spark, "batch"))
    runner.land(seed_feeds(spark), batch)
    load(spark, batch, DAYS[0], DAYS[-1] + ONE)
    assert fact(spark, layout) == fact(spark, batch)
    # a delivery that came before changes nothing; a dearer one the slice of its date
    land_late(spark, layout, dt.date(2026, 8, 23))
    assert pick_up() == second
    land_late(spark, layout, dt.date(2026, 8, 24), amount="1300.00")
    third = pick_up()
    assert {d for d in third if third[d] != second.get(d)} == {DAYS[0]}
    assert ("MKT-SALE-AMZ-2026-08-19-101", Decimal("1300.00")) in {
        (r.sale_id, r.sales_amount) for r in runner.read_fact(spark, layout).collect()}


def test_a_full_load_looks_no_sale_up(spark, monkeypatch):
    """The index holds no date outside the range, so the ids of the load aren't joined to it; a day's load is."""
    layout = runner.Layout(scratch_path(spark, "full"))
    runner.land(seed_feeds(spark), layout)
    asked, entries = [], key_index.sale_entries

    def counted(spark, path, ids=None):
        asked.append(ids is not None)
        return entries(spark, path, ids)

    monkeypatch.setattr(key_index, "sale_entries", counted)
    for _ in range(2):
        load(spark, layout, DAYS[0], DAYS[-1] + ONE)
    once = fact(spark, layout)
    assert not any(asked) and len(once) > 0
    load(spark, layout, DAYS[1])
    assert any(asked) and fact(spark, layout) == once


def test_rows_are_held_against_the_manifest_only_where_a_date_was_replaced(spark):
    path, days = scratch_path(spark, "whole"), [dt.date(2026, 8, d) for d in range(1, 5)]

    def rows(some, n):
        return spark.createDataFrame([(d, k) for d in [*some, None] for k in range(n)], "day date, k int")

    def read(**more):
        found = slices.read(spark, path, "day", **more)
        return found, found._jdf.queryExecution().optimizedPlan().toString()

    slices.replace(rows(days, 3), path, "day", lambda d: F.lit(True))
    for where, n in ((None, 15), (slices.between(days[0], days[2]), 6)):
        found, plan = read(where=where)
        assert "Join" not in plan and found.count() == n
    slices.replace(rows(days[:1], 2), path, "day", lambda d: (d == F.lit(days[0])) | d.isNull())
    found, plan = read()
    assert "Join" in plan and found.count() == 13
    assert sorted(r.k for r in found.filter("day IS NULL OR day = '2026-08-01'").collect()) == [0, 0, 1, 1]
    found, plan = read(where=lambda d: d.isNull())
    assert "Join" not in plan and found.count() == 2
    # a manifest from before the number of dates was kept
    held = dimensions.read_latest(spark, f"{path}/manifest").drop("written").cache()
    held.count()
    dimensions.write_version(held, f"{path}/manifest")
    assert read()[0].count() == 13
    slices.replace(rows(days[1:2], 5).filter("day IS NOT NULL"), path, "day", lambda d: d == F.lit(days[1]))
    assert read(where=lambda d: d == F.lit(days[1]))[0].count() == 5


def test_landed_rows_are_staged_without_a_shuffle(spark, monkeypatch):
    layout, plans = runner.Layout(scratch_path(spark, "staged")), {}
    runner.land(seed_feeds(spark), layout)
    replace = slices.replace

    def seen(rows, path, column, *args, **more):
        plans[path.rsplit("/", 1)[1]] = more.get("clustered")
        return replace(rows, path, column, *args, **more)

    monkeypatch.setattr(slices, "replace", seen)
    load(spark, layout, DAYS[0], DAYS[-1] + ONE)
    assert plans["staged_orders"] and plans["staged_sales"] and not plans["fact_sales"]
