"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator of the lakehouse, each over the whole benchmark tables.

Results are normalised at the boundary (``out``): integers as bigint,
money as double, times as 'yyyy-MM-dd HH:mm:ss.ffffff' text, reason arrays
as comma-joined text, so that another engine can check them exactly.
Queries that write (landing, staging, curated, dimensions, fact) write
below the session's shared folder and read the result back.
"""

from __future__ import annotations

import datetime as dt
from typing import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlake import contracts as C
from martlake.functions import scalars as S
from martlake.operators import checks, conform, dimensions, facts, key_index, quality, refunds, summaries, unify
from martlake.plans import flows, runner
from martlake.session import scratch_path
from martlake.sinks import files as sinks
from martlake.sinks import slices
from martlake.sources import extract, fixtures
from martlake.sources import files as sources
from martlake.sources.files import PARSE_ERRORS
from martlake.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AS_OF = dt.datetime(2026, 8, 19)
FULL_RANGE = (dt.date(1990, 1, 1), dt.date(2030, 1, 1))
SLICE = (dt.date(2024, 1, 8), dt.date(2024, 1, 15))
SECOND_HALF = dt.date(2024, 1, 16)


def query(name: str):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return register


def out(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c, t = F.col(f.name), f.dataType
        if isinstance(t, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(t, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(t, (T.TimestampNTZType, T.TimestampType)):
            c = S.format_timestamp(c, with_fraction=True)
        elif isinstance(t, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(t, T.ArrayType):
            c = F.array_join(c, ",")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _feeds(spark: SparkSession, sf_dir: str) -> flows.Feeds:
    return flows.feeds_from_tables(spark, sf_dir)


# ---------------------------------------------------------------------------
# Flagship and revenue
# ---------------------------------------------------------------------------
@query("channel_revenue")
def channel_revenue(spark, sf_dir):
    f = _feeds(spark, sf_dir)
    return flows.channel_revenue(flows.settled_sales(f), flows.channel_dim(spark, f))


@query("channel_revenue_web_refunds")
def channel_revenue_web_refunds(spark, sf_dir):
    f = _feeds(spark, sf_dir)
    return flows.channel_revenue(flows.settled_sales(f, refund_rule=True), flows.channel_dim(spark, f))


@query("fact_channel_revenue")
def fact_channel_revenue(spark, sf_dir):
    """The published query over the star schema, with a marketplace that the
    seeded channels don't know."""
    f = _feeds(spark, sf_dir)
    f.sales = f.sales.withColumn("marketplace_name", F.when(F.col("product_id") % 10 == 3, F.lit("Meesho"))
                                 .otherwise(F.col("marketplace_name")))
    return flows.fact_channel_revenue(flows.fact_sales(spark, f, AS_OF, refund_rule=True), flows.channel_dim(spark, f))


def _written(df: DataFrame, name: str) -> DataFrame:
    """Written and read back: several steps read it."""
    path = scratch_path(df.sparkSession, name)
    sinks.write_parquet(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@query("summary_channel_revenue")
def summary_channel_revenue(spark, sf_dir):
    """The same from the summary by date: kept with the whole fact first without refunds, then one half of its dates
    after the other with them.  The settled sales and the fact are written once and read by the steps that need them."""
    f = _feeds(spark, sf_dir)
    f.sales = f.sales.withColumn("marketplace_name", F.when(F.col("product_id") % 10 == 3, F.lit("Meesho"))
                                 .otherwise(F.col("marketplace_name")))
    path, dims = scratch_path(spark, "revenue_by_date"), (flows.dim_products(f), flows.dim_customers(f))
    channels = flows.channel_dim(spark, f)
    seen, given = Observation(), flows.valid_refunds(f)
    unified = flows.unified_sales(f, refund_rule=True).observe(seen, F.count_if(F.col("transaction_date").isNull()).alias("undated"))
    settled = _written(refunds.settle(unify.dedup_sales(unified), given), "settled_sales")
    unrefunded = refunds.settle(settled.drop("refund_amount"), sources.empty(spark, C.MKT_REFUNDS))
    summaries.replace(facts.lookup_keys(unrefunded, *dims, channels, AS_OF), path, slices.between(*FULL_RANGE))
    if seen.get["undated"]:  # sales with a delivery that takes the run's time: picked anew
        settled = flows.redated(settled, f, given, AS_OF)
    fact = _written(facts.lookup_keys(settled, *dims, channels, AS_OF), "fact_sales")
    for half in (slices.between(FULL_RANGE[0], SECOND_HALF), slices.between(SECOND_HALF, FULL_RANGE[1])):
        summaries.replace(fact.filter(half(F.col("sale_date"))), path, half)
    return summaries.revenue(spark, path, channels)


@query("identity_murmur")
def identity_murmur(spark, sf_dir):
    s = fixtures.mkt_sales(spark, sf_dir).filter(F.col("customer_email").isNotNull())
    return s.select(F.col("customer_email").alias("email")).distinct() \
            .select("email", S.identity_murmur("email").alias("customer_id"))


def _settlement(f: flows.Feeds) -> DataFrame:
    s = flows.settled_sales(f)
    return out(s.select("sale_id", "channel_name", "sales_amount", "refund_amount",
                        (F.col("sales_amount") - F.col("refund_amount")).alias("net_amount")))


@query("refund_settlement")
def refund_settlement(spark, sf_dir):
    return _settlement(_feeds(spark, sf_dir))


@query("refund_settlement_redelivered")
def refund_settlement_redelivered(spark, sf_dir):
    """Every refund delivered again an hour later: charged once."""
    f = _feeds(spark, sf_dir)
    later = f.refunds.withColumn("refund_date", F.expr("refund_date + INTERVAL 1 HOUR"))
    f.refunds = unify.union_all(f.refunds, later)
    return _settlement(f)


# ---------------------------------------------------------------------------
# Quality split
# ---------------------------------------------------------------------------
@query("dq_valid_orders")
def dq_valid_orders(spark, sf_dir):
    return out(flows.valid_orders(_feeds(spark, sf_dir)))


@query("dq_quarantine_orders")
def dq_quarantine_orders(spark, sf_dir):
    return out(quality.quarantined(flows.classified_orders(_feeds(spark, sf_dir))))


@query("dq_valid_sales")
def dq_valid_sales(spark, sf_dir):
    return out(flows.valid_sales(_feeds(spark, sf_dir)))


@query("dq_quarantine_sales")
def dq_quarantine_sales(spark, sf_dir):
    return out(quality.quarantined(flows.classified_sales(_feeds(spark, sf_dir))))


@query("dq_reason_counts")
def dq_reason_counts(spark, sf_dir):
    f = _feeds(spark, sf_dir)
    return out(quality.reason_counts(flows.classified_orders(f), "orders")
               .unionByName(quality.reason_counts(flows.classified_sales(f), "sales")))


@query("dq_split_totals")
def dq_split_totals(spark, sf_dir):
    f = _feeds(spark, sf_dir)
    return out(quality.split_totals(f.orders, "orders", quality.web_order_rules())
               .unionByName(quality.split_totals(f.sales, "sales", quality.mkt_sale_rules()))
               .unionByName(quality.split_totals(f.refunds, "refunds", quality.refund_rules())))


@query("dq_quarantine_refunds")
def dq_quarantine_refunds(spark, sf_dir):
    """Refunds with a negative amount (every second id) and without an
    amount (every seventh) planted."""
    f = _feeds(spark, sf_dir)
    n = F.substring("refund_id", 9, 1 << 30).cast("bigint")
    planted = f.refunds.withColumn("refund_amount", F.when(n % 7 == 0, F.lit(None)).when(n % 2 == 0, -F.col("refund_amount"))
                                   .otherwise(F.col("refund_amount")).cast(C.MONEY))
    c = quality.classify(planted, quality.refund_rules())
    return out(quality.quarantined(c).select("refund_id", "refund_amount", "reasons"))


# ---------------------------------------------------------------------------
# Conform, scalars
# ---------------------------------------------------------------------------
@query("conform_orders")
def conform_orders(spark, sf_dir):
    f = _feeds(spark, sf_dir)
    return out(conform.web_sales(flows.valid_orders(f), AS_OF))


@query("conform_sales")
def conform_sales(spark, sf_dir):
    f = _feeds(spark, sf_dir)
    return out(conform.marketplace_sales(flows.valid_sales(f)))


@query("conform_products")
def conform_products(spark, sf_dir):
    return out(flows.curated_products(_feeds(spark, sf_dir)))


@query("scalar_parse_timestamp")
def scalar_parse_timestamp(spark, sf_dir):
    ev = fixtures.table(spark, sf_dir, "events")
    text = (F.when(F.col("user_id") % 17 == 0, F.lit("not a time"))
             .when(F.col("event_id") % 2 == 0, S.format_timestamp("ts", with_fraction=True))
             .otherwise(S.format_timestamp("ts")))
    e = ev.select("event_id", text.alias("ts_text"))
    return out(e.select("event_id", "ts_text", S.parse_timestamp("ts_text").alias("parsed_ts")))


@query("scalar_timestamp_fallback")
def scalar_timestamp_fallback(spark, sf_dir):
    orders = fixtures.web_orders(spark, sf_dir)
    planted = orders.withColumn("created_at", F.when(F.col("order_id") % 101 == 0, F.lit(None))
                                .otherwise(F.col("created_at")))
    valid = quality.valid(quality.classify(planted, quality.web_order_rules()))
    return out(conform.web_sales(valid, AS_OF).select("sale_id", "transaction_date"))


@query("scalar_format_timestamp")
def scalar_format_timestamp(spark, sf_dir):
    ev = fixtures.table(spark, sf_dir, "events")
    return ev.select("event_id", S.format_timestamp("ts").alias("ts_text"))


@query("scalar_name_split")
def scalar_name_split(spark, sf_dir):
    s = fixtures.mkt_sales(spark, sf_dir)
    return s.select("transaction_id", "customer_name",
                    S.first_name("customer_name").alias("first_name"),
                    S.last_name("customer_name").alias("last_name"))


@query("identity_md5")
def identity_md5(spark, sf_dir):
    s = fixtures.mkt_sales(spark, sf_dir).filter(F.col("customer_email").isNotNull())
    return s.select(F.col("customer_email").alias("email")).distinct() \
            .select("email", S.identity_md5("email").alias("customer_id"))


@query("derive_partitions")
def derive_partitions(spark, sf_dir):
    d = flows.curated_sales(_feeds(spark, sf_dir))
    return out(S.with_partition_columns(d).select("sale_id", "sale_date", "year", "month", "day"))


# ---------------------------------------------------------------------------
# Union and de-duplication
# ---------------------------------------------------------------------------
@query("unify_sales")
def unify_sales(spark, sf_dir):
    return out(flows.unified_sales(_feeds(spark, sf_dir)))


@query("dedup_sales")
def dedup_sales(spark, sf_dir):
    return out(flows.curated_sales(_feeds(spark, sf_dir)))


@query("unify_customers")
def unify_customers(spark, sf_dir):
    return out(flows.unified_customers(_feeds(spark, sf_dir)))


@query("dedup_customer_id")
def dedup_customer_id(spark, sf_dir):
    return out(flows.curated_customers(_feeds(spark, sf_dir)))


def _mkt_customers(spark, sf_dir) -> DataFrame:
    return conform.marketplace_customers(flows.valid_sales(_feeds(spark, sf_dir)))


@query("dedup_customer_email")
def dedup_customer_email(spark, sf_dir):
    return out(unify.dedup_customers(_mkt_customers(spark, sf_dir), ["email"]))


@query("dedup_customer_email_channel")
def dedup_customer_email_channel(spark, sf_dir):
    return out(unify.dedup_customers(_mkt_customers(spark, sf_dir), ["email", "source_system"]))


def _second_extract(products: DataFrame) -> DataFrame:
    """A later full extract of the catalogue: LARGE items renamed and
    repriced."""
    large = F.col("category") == "LARGE"
    return products.select(
        "product_id",
        F.when(large, F.upper("product_name")).otherwise(F.col("product_name")).alias("product_name"),
        "category",
        F.when(large, F.col("price") + F.lit(1).cast(C.MONEY)).otherwise(F.col("price"))
         .cast(C.MONEY).alias("price"),
        "source_system")


@query("dim_latest_products")
def dim_latest_products(spark, sf_dir):
    cp = flows.curated_products(_feeds(spark, sf_dir))
    staged = unify.union_all(cp, _second_extract(cp))
    return out(unify.first_by(staged, ["product_id", "source_system"], "product_name"))


@query("dim_latest_customers")
def dim_latest_customers(spark, sf_dir):
    staged = flows.unified_customers(_feeds(spark, sf_dir))
    return out(unify.first_by(staged, ["customer_id", "source_system"], "first_name"))


# ---------------------------------------------------------------------------
# Dimensions
# ---------------------------------------------------------------------------
@query("dim_keys_products")
def dim_keys_products(spark, sf_dir):
    d = flows.dim_products(_feeds(spark, sf_dir))
    return d.select("product_id", "source_system", "product_key")


@query("dim_keys_customers")
def dim_keys_customers(spark, sf_dir):
    d = flows.dim_customers(_feeds(spark, sf_dir))
    return d.select("customer_id", "source_system", "customer_key")


@query("merge_products")
def merge_products(spark, sf_dir):
    key, nat = C.DIM_PRODUCTS_KEY
    cp = flows.curated_products(_feeds(spark, sf_dir))
    first = dimensions.scd1_upsert(None, cp.filter(F.col("category") != "PROMO"), key, nat, "product_name")
    path = scratch_path(spark, "dim_products")
    dimensions.write_version(first, path)
    merged = dimensions.scd1_upsert(dimensions.read_latest(spark, path), _second_extract(cp),
                                    key, nat, "product_name")
    dimensions.write_version(merged, path)
    return out(dimensions.read_latest(spark, path))


@query("merge_customers")
def merge_customers(spark, sf_dir):
    key, nat = C.DIM_CUSTOMERS_KEY
    f = _feeds(spark, sf_dir)
    valid = flows.valid_sales(f)
    web = conform.web_customers(f.customers)
    early = conform.marketplace_customers(valid.filter(
        F.col("transaction_date") < S.ntz(SECOND_HALF)))
    first = dimensions.scd1_upsert(None, unify.union_all(web, early), key, nat, "first_name")
    path = scratch_path(spark, "dim_customers")
    dimensions.write_version(first, path)
    moved = web.withColumn("phone", F.when(F.col("customer_id") % 3 == 0,
                                           F.concat(F.lit("97"), F.col("customer_id")))
                           .otherwise(F.col("phone")))
    incoming = unify.union_all(moved, conform.marketplace_customers(valid))
    merged = dimensions.scd1_upsert(dimensions.read_latest(spark, path), incoming, key, nat, "first_name")
    dimensions.write_version(merged, path)
    return out(dimensions.read_latest(spark, path))


@query("merge_customers_buckets")
def merge_customers_buckets(spark, sf_dir):
    """The merge of ``merge_customers`` into a table of buckets, and once more, which changes nothing."""
    f = _feeds(spark, sf_dir)
    web, mkt = conform.web_customers(f.customers), conform.marketplace_customers
    valid = flows.valid_sales(f)
    path = scratch_path(spark, "dim_customers")
    moved = web.withColumn("phone", F.when(F.col("customer_id") % 3 == 0, F.concat(F.lit("97"), F.col("customer_id")))
                           .otherwise(F.col("phone")))
    early = mkt(valid.filter(F.col("transaction_date") < S.ntz(SECOND_HALF)))
    for part in ((web, early), (moved, mkt(valid)), (moved, mkt(valid))):
        dimensions.upsert_buckets(spark, path, unify.union_all(*part), *C.DIM_CUSTOMERS_KEY, "first_name")
    return out(dimensions.read_latest(spark, path))


@query("dim_channels_seed")
def dim_channels_seed(spark, sf_dir):
    return dimensions.channels(spark, flows.unified_sales(_feeds(spark, sf_dir)))


# ---------------------------------------------------------------------------
# Fact
# ---------------------------------------------------------------------------
_FACT_OUT = ["sale_id", "product_key", "customer_key", "channel_key", "quantity_sold",
             "sales_amount", "refund_amount", "transaction_date", "sale_date"]


@query("fact_key_lookup")
def fact_key_lookup(spark, sf_dir):
    return out(flows.fact_sales(spark, _feeds(spark, sf_dir), AS_OF, refund_rule=True).select(*_FACT_OUT))


@query("fact_defaults")
def fact_defaults(spark, sf_dir):
    f = _feeds(spark, sf_dir)
    fact = flows.fact_sales(spark, f, AS_OF, refund_rule=False)
    return out(fact.select("sale_id", "refund_amount", "ingestion_timestamp"))


@query("contract_fk_fact")
def contract_fk_fact(spark, sf_dir):
    """Products of every seventh id and customers of every ninth are missing
    from the dimensions."""
    f = _feeds(spark, sf_dir)
    dims = (flows.dim_products(f).filter(F.col("product_id") % 7 != 0),
            flows.dim_customers(f).filter(F.col("customer_id") % 9 != 0))
    return out(facts.orphans(flows.fact_sales(spark, f, AS_OF, dims=dims)))


@query("contract_pk_fact")
def contract_pk_fact(spark, sf_dir):
    """Rows and distinct ids of the fact, where every sale is delivered twice."""
    f = _feeds(spark, sf_dir)
    f.sales = unify.union_all(f.sales, f.sales)
    f.orders = unify.union_all(f.orders, f.orders)
    return flows.fact_sales(spark, f, AS_OF).agg(F.count(F.lit(1)).alias("n_rows"),
                                                 F.count_distinct("sale_id").alias("n_ids"))


@query("contract_not_null_warehouse")
def contract_not_null_warehouse(spark, sf_dir):
    f = _feeds(spark, sf_dir)
    dp, dc = flows.dim_products(f), flows.dim_customers(f)
    return checks.null_counts({"dim_products": dp, "dim_customers": dc,
                               "fact_sales": flows.fact_sales(spark, f, AS_OF, dims=(dp, dc))}, C.NOT_NULL)


@query("contract_varchar_warehouse")
def contract_varchar_warehouse(spark, sf_dir):
    f = _feeds(spark, sf_dir)
    dp, dc = flows.dim_products(f), flows.dim_customers(f)
    return checks.length_violations({"dim_products": dp, "dim_customers": dc,
                                     "fact_sales": flows.fact_sales(spark, f, AS_OF, dims=(dp, dc))}, C.VARCHAR_LIMITS)


@query("fact_slice_replace")
def fact_slice_replace(spark, sf_dir):
    f = _feeds(spark, sf_dir)
    path = scratch_path(spark, "fact_sales")
    dims = (flows.dim_products(f), flows.dim_customers(f))
    curated = flows.curated_sales(f)
    no_refunds = refunds.settle(curated, sources.empty(spark, C.MKT_REFUNDS))
    ch = flows.channel_dim(spark, f)
    slices.replace(facts.lookup_keys(no_refunds, *dims, ch, AS_OF), path, "sale_date", slices.between(*FULL_RANGE))
    settled = refunds.settle(curated, flows.valid_refunds(f))
    again = facts.lookup_keys(settled, *dims, ch, AS_OF).filter(slices.between(*SLICE)(F.col("sale_date")))
    slices.replace(again, path, "sale_date", slices.between(*SLICE))
    return out(slices.read(spark, path, "sale_date").select("sale_id", "refund_amount", "sale_date"))


def _landed_run(spark, sf_dir, times: int) -> DataFrame:
    layout = runner.Layout(scratch_path(spark, "lakehouse"))
    runner.land(_feeds(spark, sf_dir), layout)
    for _ in range(times):
        runner.run_range(spark, layout, *FULL_RANGE, as_of=AS_OF, web_refund_rule=True)
    return out(runner.read_fact(spark, layout).select(*_FACT_OUT))


@query("load_range_run")
def load_range_run(spark, sf_dir):
    return _landed_run(spark, sf_dir, 1)


@query("load_by_parts")
def load_by_parts(spark, sf_dir):
    """The landing zone loaded in several runs, the newest days first: late arrivals, refunds of sales that another
    run loads and redelivered sales find their dates through the indexes.  The same fact as one load's."""
    layout = runner.Layout(scratch_path(spark, "lakehouse"))
    runner.land(_feeds(spark, sf_dir), layout)
    cuts = [FULL_RANGE[0], dt.date(1995, 6, 17), dt.date(2024, 1, 9), SECOND_HALF, FULL_RANGE[1]]
    for start, end in reversed(list(zip(cuts, cuts[1:]))):
        runner.run_range(spark, layout, start, end, as_of=AS_OF, web_refund_rule=True)
    return out(runner.read_fact(spark, layout).select(*_FACT_OUT))


@query("refund_totals_merged")
def refund_totals_merged(spark, sf_dir):
    """Totals kept by merging three days of refund deliveries: first as they came; then a third delivered again,
    later and 1 dearer; then every fifth of the first ones withdrawn and the day loaded again."""
    path = scratch_path(spark, "refund_index")
    feed = flows.valid_refunds(_feeds(spark, sf_dir))
    n = F.substring("refund_id", 9, 1 << 30).cast("bigint")

    def day(k: int, rows: DataFrame) -> None:
        landed = rows.withColumn("landing_day", F.lit(dt.date(2024, 1, k)))
        key_index.update_refunds(landed, path, feed.select("refund_id"), lambda d: d == F.lit(dt.date(2024, 1, k)))

    day(1, feed)
    day(2, feed.filter(n % 3 == 0).withColumn("refund_date", F.expr("refund_date + INTERVAL 1 HOUR"))
        .withColumn("refund_amount", (F.col("refund_amount") + 1).cast(C.MONEY)))
    day(1, feed.filter(n % 5 != 0))
    totals = key_index.refund_totals(spark, path)
    return out(totals.select(F.col("original_transaction_id").alias("sale_id"), F.col("_refunded").alias("refunded")))


@query("dq_split_observed")
def dq_split_observed(spark, sf_dir):
    """The split's counts, observed while the classified feeds are written."""
    f = _feeds(spark, sf_dir)
    ok = F.size(quality.REASONS) == 0
    counts = {"n_input": F.count(F.lit(1)), "n_valid": F.count_if(ok), "n_quarantined": F.count_if(~ok)}
    rows = []
    for feed, df in (("orders", flows.classified_orders(f)), ("sales", flows.classified_sales(f)),
                     ("refunds", quality.classify(f.refunds, quality.refund_rules()))):
        seen = slices.replace(df.withColumn("day", F.lit(None).cast("date")), scratch_path(spark, f"staged_{feed}"), "day",
                              lambda d: d.isNull(), counts)
        rows.append((feed, *(seen[c] for c in counts)))
    return spark.createDataFrame(rows, "feed string, n_input long, n_valid long, n_quarantined long")


@query("fact_rerun_idempotent")
def fact_rerun_idempotent(spark, sf_dir):
    return _landed_run(spark, sf_dir, 2)


# ---------------------------------------------------------------------------
# Contracts
# ---------------------------------------------------------------------------
@query("contract_fk_orders")
def contract_fk_orders(spark, sf_dir):
    f = _feeds(spark, sf_dir)
    customers, products = f.customers.filter("customer_id % 7 != 0"), f.products.filter("product_id % 11 != 0")
    return checks.fk_orphans(f.orders, "order_id", {"customer_id": (customers, "customer_id"),
                                                     "product_id": (products, "product_id")})


@query("contract_unique_email")
def contract_unique_email(spark, sf_dir):
    return checks.duplicate_keys(flows.unified_customers(_feeds(spark, sf_dir)), ["email"],
                                 ["customer_id", "source_system"])


@query("contract_pk_sales")
def contract_pk_sales(spark, sf_dir):
    return checks.duplicate_keys(flows.unified_sales(_feeds(spark, sf_dir)), ["sale_id"])


@query("contract_not_null")
def contract_not_null(spark, sf_dir):
    f = _feeds(spark, sf_dir)
    return checks.null_counts({"orders": f.orders, "customers": f.customers, "products": f.products},
                              C.NOT_NULL)


@query("contract_varchar_length")
def contract_varchar_length(spark, sf_dir):
    f = _feeds(spark, sf_dir)
    return checks.length_violations({"orders": f.orders, "customers": f.customers,
                                     "products": f.products}, C.VARCHAR_LIMITS)


# ---------------------------------------------------------------------------
# Sources
# ---------------------------------------------------------------------------
@query("src_extract_customers")
def src_extract_customers(spark, sf_dir):
    return out(extract.full_extract(fixtures.created(fixtures.web_customers(spark, sf_dir), "customer_id"),
                                    extract.CUSTOMER_COLUMNS))


@query("src_extract_products")
def src_extract_products(spark, sf_dir):
    return out(extract.full_extract(fixtures.created(fixtures.web_products(spark, sf_dir), "product_id"),
                                    extract.PRODUCT_COLUMNS))


@query("src_extract_orders_day")
def src_extract_orders_day(spark, sf_dir):
    return out(extract.day_extract(fixtures.web_orders(spark, sf_dir),
                                   dt.date(1996, 1, 1), dt.date(1997, 1, 1)))


def _land_csv(spark, df: DataFrame, name: str) -> str:
    path = scratch_path(spark, name)
    sinks.write_csv_landing(df, path)
    return path


@query("src_csv_orders")
def src_csv_orders(spark, sf_dir):
    path = _land_csv(spark, fixtures.web_orders(spark, sf_dir), "landing_orders")
    return out(sources.read_csv_feed(spark, path, C.ORDERS).drop(PARSE_ERRORS))


@query("src_csv_products")
def src_csv_products(spark, sf_dir):
    path = _land_csv(spark, fixtures.web_products(spark, sf_dir), "landing_products")
    return out(sources.read_csv_feed(spark, path, C.PRODUCTS).drop(PARSE_ERRORS))


@query("src_csv_customers")
def src_csv_customers(spark, sf_dir):
    path = _land_csv(spark, fixtures.web_customers(spark, sf_dir), "landing_customers")
    return out(sources.read_csv_feed(spark, path, C.CUSTOMERS).drop(PARSE_ERRORS))


def _land_sales_ndjson(spark, sf_dir) -> str:
    path = scratch_path(spark, "landing_sales")
    sinks.write_ndjson_landing(sinks.with_dated_keys(fixtures.mkt_sales(spark, sf_dir), "transaction_date"),
                               path, ["year", "month", "day"])
    return path


@query("src_ndjson_sales")
def src_ndjson_sales(spark, sf_dir):
    path = _land_sales_ndjson(spark, sf_dir)
    return out(sources.read_ndjson_feed(spark, path, C.MKT_SALES).drop(PARSE_ERRORS))


@query("src_ndjson_refunds")
def src_ndjson_refunds(spark, sf_dir):
    path = scratch_path(spark, "landing_refunds")
    sinks.write_ndjson_landing(fixtures.mkt_refunds(spark, sf_dir), path)
    return out(sources.read_ndjson_feed(spark, path, C.MKT_REFUNDS).drop(PARSE_ERRORS))


@query("src_ndjson_corrupt")
def src_ndjson_corrupt(spark, sf_dir):
    """Sales landed as NDJSON text where every 13th event's line is cut
    short; the feed is read and split, and reasons are counted."""
    s = fixtures.mkt_sales(spark, sf_dir)
    line = F.to_json(F.struct(*[S.format_timestamp(c).alias(c) if c == "transaction_date" else F.col(c)
                                for c in s.columns]))
    cut = F.substring("transaction_id", 5, 1 << 30).cast("bigint") % 13 == 0
    text = s.select(F.when(cut, F.substring(line, 1, 20)).otherwise(line).alias("value"))
    path = scratch_path(spark, "landing_sales_corrupt")
    text.write.mode("overwrite").text(path)
    typed = sources.read_ndjson_feed(spark, path, C.MKT_SALES, glob="*.txt")
    classified = quality.classify(typed, quality.mkt_sale_rules(), PARSE_ERRORS)
    return out(quality.reason_counts(classified, "sales"))


@query("src_empty_fallback")
def src_empty_fallback(spark, sf_dir):
    """A run whose marketplace folder holds no files: the sales feed falls
    back to an empty frame of its contract and the run goes on."""
    root = scratch_path(spark, "landing")
    sinks.write_csv_landing(fixtures.web_orders(spark, sf_dir), f"{root}/orders")
    orders = sources.read_csv_feed(spark, f"{root}/orders", C.ORDERS)
    sales = sources.read_ndjson_feed(spark, f"{root}/sales", C.MKT_SALES)
    feeds = flows.Feeds(orders=orders, sales=sales,
                        refunds=sources.empty(spark, C.MKT_REFUNDS),
                        products=sources.empty(spark, C.PRODUCTS),
                        customers=sources.empty(spark, C.CUSTOMERS),
                        orders_errors=PARSE_ERRORS, sales_errors=PARSE_ERRORS)
    u = flows.unified_sales(feeds)
    return u.groupBy("channel_name").agg(F.count(F.lit(1)).alias("n_sales"))


@query("src_dated_slice")
def src_dated_slice(spark, sf_dir):
    path = scratch_path(spark, "landing_sales_by_date")
    s = fixtures.mkt_sales(spark, sf_dir).withColumn("dt", F.to_date("transaction_date"))
    sinks.write_partitioned_parquet(s, path, ["dt"])
    return out(sources.read_dated_slice(spark, path, *SLICE, date_col="dt"))


_CURATED_FILE = T.StructType(C.SALES.fields + [T.StructField("refund_amount", C.MONEY, True)])


def _stage_sales(spark, sf_dir) -> DataFrame:
    path = scratch_path(spark, "curated_sales")
    curated = flows.curated_sales(_feeds(spark, sf_dir)).withColumn("sale_date", F.to_date("transaction_date"))
    sinks.write_partitioned_parquet(curated, path, ["sale_date"])
    return sources.read_staged_parquet(spark, path, _CURATED_FILE, _CURATED_FILE)


@query("stage_sales")
def stage_sales(spark, sf_dir):
    return out(_stage_sales(spark, sf_dir).drop("refund_amount"))


@query("stage_missing_column")
def stage_missing_column(spark, sf_dir):
    return out(_stage_sales(spark, sf_dir).select("sale_id", "refund_amount"))


@query("stage_products")
def stage_products(spark, sf_dir):
    path = scratch_path(spark, "curated_products")
    sinks.write_parquet(flows.curated_products(_feeds(spark, sf_dir)), path)
    return out(sources.read_staged_parquet(spark, path, C.CURATED_PRODUCTS, C.CURATED_PRODUCTS))


@query("stage_customers")
def stage_customers(spark, sf_dir):
    path = scratch_path(spark, "curated_customers")
    sinks.write_parquet(flows.curated_customers(_feeds(spark, sf_dir)), path)
    return out(sources.read_staged_parquet(spark, path, C.CURATED_CUSTOMERS, C.CURATED_CUSTOMERS))


# ---------------------------------------------------------------------------
# Sinks
# ---------------------------------------------------------------------------
@query("snk_csv_landing")
def snk_csv_landing(spark, sf_dir):
    path = _land_csv(spark, fixtures.web_orders(spark, sf_dir), "landing_orders")
    lines = spark.read.option("pathGlobFilter", "*.csv").text(path)
    header = ",".join(f.name for f in C.ORDERS.fields)
    return lines.filter(F.col("value") != header).select(F.col("value").alias("line"))


@query("snk_ndjson_landing")
def snk_ndjson_landing(spark, sf_dir):
    path = _land_sales_ndjson(spark, sf_dir)
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").text(path)
    return lines.select(
        F.get_json_object("value", "$.transaction_id").alias("transaction_id"),
        F.array_join(F.array_sort(F.json_object_keys("value")), ",").alias("line_keys"))


@query("snk_sales_partitioned")
def snk_sales_partitioned(spark, sf_dir):
    path = scratch_path(spark, "curated_sales")
    curated = flows.curated_sales(_feeds(spark, sf_dir)).withColumn("sale_date", F.to_date("transaction_date"))
    sinks.write_partitioned_parquet(curated, path, ["sale_date"])
    back = spark.read.parquet(path)
    return out(back.groupBy("sale_date").agg(F.count(F.lit(1)).alias("n_rows")))


# ---------------------------------------------------------------------------
# Incremental
# ---------------------------------------------------------------------------
def _incremental_sales(spark, sf_dir) -> DataFrame:
    root = scratch_path(spark, "incremental")
    s = fixtures.mkt_sales(spark, sf_dir).withColumn("dt", F.to_date("transaction_date"))
    cut = S.ntz(SECOND_HALF)
    landing = f"{root}/landing"
    sinks.write_ndjson_landing(s.filter(F.col("transaction_date") < cut), landing, ["dt"])
    incremental.run_available_now(spark, landing, f"{root}/checkpoint", f"{root}/curated")
    sinks.write_ndjson_landing(s.filter(F.col("transaction_date") >= cut), landing, ["dt"])
    incremental.run_available_now(spark, landing, f"{root}/checkpoint", f"{root}/curated")
    return incremental.read_curated(spark, f"{root}/curated")


@query("incremental_sales")
def incremental_sales(spark, sf_dir):
    return out(_incremental_sales(spark, sf_dir))


@query("incremental_fact")
def incremental_fact(spark, sf_dir):
    """Everything but the marketplace sales is loaded in one run; a stream picks the sales up in two parts and
    brings the fact up to date itself, which gives the batch load's fact."""
    layout = runner.Layout(scratch_path(spark, "lakehouse"))
    f = _feeds(spark, sf_dir)
    sales, f.sales = f.sales, f.sales.limit(0)
    runner.land(f, layout)
    runner.run_range(spark, layout, *FULL_RANGE, as_of=AS_OF, web_refund_rule=True)
    cut = S.ntz(SECOND_HALF)
    for part in (sales.filter(F.col("transaction_date") < cut), sales.filter(F.col("transaction_date") >= cut)):
        runner.land_sales(part, layout)
        incremental.run_into_fact(spark, layout, f"{layout.root}/checkpoint", AS_OF)
    return out(runner.read_fact(spark, layout).select(*_FACT_OUT))
