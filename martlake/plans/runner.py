"""One load run over date ranges: landing -> staged -> curated -> warehouse.

``land`` writes the operational feeds into the landing zone (CSV for the
database extracts, NDJSON for marketplace feeds, both packed).  ``run_range`` then, for
the landing days in [start, end):

1. reads the landing feeds by contract, classifies them and replaces their
   slices of the staged tables, by landing day (rows that landed without a
   day are one slice); the invalid rows are the quarantine, and the split's
   counts are observed on the writes;
2. updates the indexes of sales and refunds (``operators.key_index``) and
   asks them which event dates the landed rows touch (late arrivals, other
   deliveries of the same sale, refunds);
3. rebuilds every event date that is in the range or touched, from the
   staged rows of the landing days that hold it, whichever run landed them;
   of the deliveries of one sale only the newest counts, whatever its date;
4. upserts the product and customer dimensions (buckets with a new or
   changed member are written again);
5. settles refunds (each refund_id once, whatever its date) and replaces the
   fact's slices of those dates, and with them the revenue summary's.

So the tables only depend on what has landed, not on which ranges were run,
in which order or how often (asserted in the tests), and a run reads staged
rows of the dates it rebuilds and the indexes' buckets of its ids, not the
history.  A full rebuild is just a wide range.

A run first notes its ranges and what its landing days held before; the note
is taken back when it ends.  A run that finds such a note (its
predecessor broke off) loads those days too, whatever its own range.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlake import contracts as C
from martlake.functions import scalars as S
from martlake.operators import conform, dimensions, facts, key_index, quality, summaries, unify
from martlake.operators import refunds as refund_ops
from martlake.plans import flows
from martlake.session import without_old_shuffles
from martlake.sinks import files as sinks
from martlake.sinks import slices
from martlake.sources import files as sources
from martlake.sources.files import LANDING_DAY, PARSE_ERRORS

EVENT_DATE = "event_date"
PACKED_TEXT = "gzip"


@dataclass(frozen=True)
class Layout:
    root: str

    def __getattr__(self, name: str) -> str:  # landing_orders, dim_products, ...
        if name.startswith("_"):
            raise AttributeError(name)
        return f"{self.root}/{name}"


def land(feeds: flows.Feeds, layout: Layout) -> None:
    with without_old_shuffles(feeds.orders.sparkSession):
        sinks.write_csv_landing(feeds.orders, layout.landing_orders, day_of="created_at", compression=PACKED_TEXT)
        sinks.write_csv_landing(feeds.products, layout.landing_products, compression=PACKED_TEXT)
        sinks.write_csv_landing(feeds.customers, layout.landing_customers, compression=PACKED_TEXT)
        land_sales(feeds.sales, layout)
        sinks.write_ndjson_landing(feeds.refunds, layout.landing_refunds, day_of="refund_date", compression=PACKED_TEXT)


def land_sales(sales: DataFrame, layout: Layout) -> None:
    sinks.write_ndjson_landing(sales, layout.landing_sales, day_of="transaction_date", compression=PACKED_TEXT)


# feed -> (contract, format, rules, event time)
DATED = {
    "orders": (C.ORDERS, "csv", quality.web_order_rules, "created_at"),
    "sales": (C.MKT_SALES, "json", quality.mkt_sale_rules, "transaction_date"),
    "refunds": (C.MKT_REFUNDS, "json", quality.refund_rules, "refund_date"),
}
WHOLE = {"products": (C.PRODUCTS, quality.product_rules), "customers": (C.CUSTOMERS, quality.customer_rules)}


def staged_schema(feed: str) -> T.StructType:
    return T.StructType(DATED[feed][0].fields + [
        T.StructField(LANDING_DAY, T.DateType()), T.StructField(EVENT_DATE, T.DateType()),
        T.StructField(quality.REASONS, T.ArrayType(T.StringType())), T.StructField("is_valid", T.BooleanType())])


def landed(spark: SparkSession, layout: Layout, feed: str, days) -> DataFrame:
    """The classified rows of a dated landing feed of the landing ``days`` (a
    predicate on the date), and those that landed without a day.

    An order whose time is missing or unreadable belongs to the day folder it
    landed in (the extract is per day), so it takes that day; without a day
    it is quarantined as ``undated`` (sales as ``bad_timestamp``)."""
    contract, fmt, rules, event = DATED[feed]
    raw = sources.read_dated_feed(spark, getattr(layout, f"landing_{feed}"), contract, fmt, days=days)
    if feed == "orders":
        undated = F.col(event).isNull() & F.col(LANDING_DAY).isNull()
        errors = F.array_remove(F.col(PARSE_ERRORS), f"bad_{event}")
        raw = (raw.withColumn(PARSE_ERRORS, F.when(undated, F.array_append(errors, F.lit("undated"))).otherwise(errors))
               .withColumn(event, F.coalesce(event, F.col(LANDING_DAY).cast("timestamp_ntz"))))
    classified = quality.classify(raw, rules(), PARSE_ERRORS)
    return (classified.withColumn(EVENT_DATE, F.to_date(event))
            .withColumn("is_valid", F.size(quality.REASONS) == 0).select(*staged_schema(feed).fieldNames()))


def staged(spark: SparkSession, layout: Layout, feed: str, days=None) -> DataFrame:
    """Staged rows, of all landing days or of those ``days`` chooses."""
    return slices.read(spark, getattr(layout, f"staged_{feed}"), LANDING_DAY, staged_schema(feed), days)


def staged_valid(spark: SparkSession, layout: Layout, feed: str, days=None) -> DataFrame:
    return staged(spark, layout, feed, days).filter("is_valid")


def all_sales(spark: SparkSession, layout: Layout, web_refund_rule: bool, days, dates) -> DataFrame:
    """Every valid delivery for the event ``dates`` that landed on ``days`` (predicates), conformed, with its
    landing-independent sale_date."""
    def rows(feed: str) -> DataFrame:
        return staged_valid(spark, layout, feed, days).filter(F.coalesce(dates(F.col(EVENT_DATE)), F.lit(False)))

    web = conform.web_sales(rows("orders"), None, web_refund_rule)
    mkt = conform.marketplace_sales(rows("sales"), web_refund_rule)
    return unify.union_all(web, mkt).withColumn("sale_date", S.sale_date("transaction_date"))


def deliveries(spark: SparkSession, layout: Layout, days) -> DataFrame:
    """sale_id, sale_date, newest (time), landing_day of the valid staged rows of the landing ``days``."""
    web, mkt = (staged_valid(spark, layout, feed, days) for feed in ("orders", "sales"))
    rest = [F.col(EVENT_DATE).alias("sale_date"), F.col("_at").alias("newest"), F.col(LANDING_DAY).alias("landing_day")]
    return (web.withColumn("_at", F.col("created_at")).select(S.web_sale_id("order_id").alias("sale_id"), *rest)
            .unionByName(mkt.withColumn("_at", F.col("transaction_date")).select(F.col("transaction_id").alias("sale_id"), *rest)))


def landed_refunds(spark: SparkSession, layout: Layout, days) -> DataFrame:
    return staged_valid(spark, layout, "refunds", days).withColumnRenamed(LANDING_DAY, "landing_day")


def whole_extract(spark: SparkSession, layout: Layout, feed: str) -> DataFrame:
    """A full extract, classified and staged (the rows with reasons are its
    quarantine); its valid rows."""
    contract, rules = WHOLE[feed]
    raw = sources.read_csv_feed(spark, getattr(layout, f"landing_{feed}"), contract)
    path = getattr(layout, f"staged_{feed}")
    dimensions.write_version(quality.classify(raw, rules(), PARSE_ERRORS), path)
    return quality.valid(dimensions.read_latest(spark, path))


Range = tuple[dt.date, dt.date]
#: What a run notes before it replaces anything: its ranges, and the sales, dates and refunds its days held.
NOTE = "sale_id string, sale_date date, refund_id string, start date, end date"


def any_of(ranges: list[Range]):
    """In one of the ranges [start, end)."""
    return lambda day: reduce(lambda a, b: a | b, (slices.between(*r)(day) for r in ranges))


def run_range(spark: SparkSession, layout: Layout, start: dt.date, end: dt.date,
              as_of: dt.datetime, web_refund_rule: bool = True) -> dict[str, dict]:
    """Load the landing days [start, end).  ``as_of`` is the ingestion time.
    Returns the range's split counts per feed."""
    return run_ranges(spark, layout, [(start, end)], as_of, web_refund_rule)


def run_ranges(spark: SparkSession, layout: Layout, ranges: list[Range], as_of: dt.datetime, web_refund_rule: bool = True,
               changed: DataFrame | None = None) -> dict[str, dict]:
    """Load the landing days of the ranges.

    ``changed`` (sale_id) says that of the sales on those days only these
    were added or delivered anew (a stream's batch knows): then only the
    event dates of these are rebuilt, and neither refunds nor the full
    extracts are read again (unless the run before this one broke off)."""
    with without_old_shuffles(spark):
        return _load(spark, layout, ranges, as_of, web_refund_rule, changed)


def _load(spark: SparkSession, layout: Layout, ranges: list[Range], as_of: dt.datetime, web_refund_rule: bool,
          changed: DataFrame | None) -> dict[str, dict]:
    before = dimensions.read_latest(spark, layout.unfinished, NOTE)
    broken = [tuple(r) for r in before.filter("start IS NOT NULL").select("start", "end").distinct().collect()]
    loaded = any_of([*ranges, *broken])
    if broken:
        changed = None

    def restaged(day: Column) -> Column:  # the ranges' landing days and the slice without a day
        return loaded(day) | day.isNull()

    # what those landing days held before: rows that are gone or moved touch their dates too
    marks = spark.createDataFrame([(None, None, None, *r) for r in ranges], NOTE)
    note = before.unionByName(marks)
    if changed is None:
        note = (note.unionByName(deliveries(spark, layout, restaged).select("sale_id", "sale_date"), allowMissingColumns=True)
                .unionByName(landed_refunds(spark, layout, restaged).select(
                    F.col("original_transaction_id").alias("sale_id"), "refund_id"), allowMissingColumns=True))
    dimensions.write_version(note, layout.unfinished)
    gone = dimensions.read_latest(spark, layout.unfinished)

    # 1. each text feed is parsed once, into its slices of the staged table
    own, ok = F.coalesce(any_of(ranges)(F.col(LANDING_DAY)), F.lit(False)), F.col("is_valid")
    counts = {"n_input": F.count_if(own), "n_valid": F.count_if(own & ok), "n_quarantined": F.count_if(own & ~ok)}
    split = {feed: slices.replace(landed(spark, layout, feed, loaded), getattr(layout, f"staged_{feed}"), LANDING_DAY,
                                  restaged, counts, clustered=True) for feed in DATED}

    # 2. the indexes, and the dates this run touches
    mine, refunds = deliveries(spark, layout, restaged), landed_refunds(spark, layout, restaged)
    ids = (mine if changed is None else changed).select("sale_id").unionByName(
        gone.filter("sale_date IS NOT NULL").select("sale_id"))
    key_index.update_sales(mine, layout.sale_index, ids, restaged)
    pairs = mine.select(F.col("landing_day").alias(LANDING_DAY), "sale_date").distinct()
    slices.replace(pairs, layout.landed_dates, LANDING_DAY, restaged)
    named = ids.unionByName(gone.select("sale_id"))
    if changed is None:
        refund_ids = refunds.select("refund_id").unionByName(gone.select("refund_id")).filter("refund_id IS NOT NULL")
        resettled = key_index.update_refunds(
            refunds, layout.refund_index, refund_ids, restaged, lambda sales: dimensions.write_version(gone.unionByName(
                sales.withColumnRenamed("original_transaction_id", "sale_id"), allowMissingColumns=True), layout.unfinished))
        named = named.unionByName(refunds.select(F.col("original_transaction_id").alias("sale_id"))).unionByName(
            resettled.select(F.col("original_transaction_id").alias("sale_id")))
    touched = touched_dates(spark, layout, named.filter("sale_id IS NOT NULL"), gone, None if changed is not None else loaded)

    # 3. curated sales of those dates, from the landing days that hold them
    curated = newest_deliveries(all_sales(spark, layout, web_refund_rule, days_holding(spark, layout, touched), touched),
                                key_index.moved_sales(spark, layout.sale_index))
    slices.replace(curated, layout.curated_sales, "sale_date", touched)
    curated = slices.read(spark, layout.curated_sales, "sale_date", curated.schema, touched)

    # 4. dimensions: new version from the current one
    sales = staged_valid(spark, layout, "sales", restaged).select(*C.MKT_SALES.fieldNames())
    dims = upsert_dimensions(spark, layout, sales, with_extracts=changed is None)
    channels = dimensions.upsert_channels(
        spark, layout.dim_channels, sales.select(F.col("marketplace_name").alias("channel_name")))

    # 5. fact slices of the same dates, settled with all refunds there are
    totals = key_index.refund_totals(spark, layout.refund_index, curated.select("sale_id"))
    settled = settled_sales(curated.drop("sale_date"), totals)
    fact = facts.lookup_keys(settled, dims["products"], dims["customers"], channels, as_of)
    slices.replace(fact, layout.fact_sales, "sale_date", touched)
    summaries.replace(read_fact(spark, layout, touched, fact.schema), layout.revenue_by_date, touched)
    dimensions.write_version(spark.createDataFrame([], NOTE), layout.unfinished)
    return split


DIMENSION_KEYS = {"products": C.DIM_PRODUCTS_KEY, "customers": C.DIM_CUSTOMERS_KEY}
BEST_BY = {"products": "product_name", "customers": "first_name"}


def upsert_dimensions(spark: SparkSession, layout: Layout, sales: DataFrame, with_extracts: bool) -> dict[str, DataFrame]:
    """Products and customers: from the full extracts and the sales, or (when there is a version already) from the
    sales alone."""
    paths = {name: getattr(layout, f"dim_{name}") for name in ("products", "customers")}
    if with_extracts or dimensions.read_latest(spark, paths["products"]) is None:
        feeds = flows.Feeds(orders=None, refunds=None, products=whole_extract(spark, layout, "products"),
                            customers=whole_extract(spark, layout, "customers"), sales=sales)
        build = {"products": flows.curated_products, "customers": flows.unified_customers}
    else:
        feeds = flows.Feeds(orders=None, refunds=None, products=None, customers=sources.empty(spark, C.CUSTOMERS), sales=sales)
        build = {"customers": flows.unified_customers}
    schemas = {}
    for name, fn in build.items():
        key, nat = DIMENSION_KEYS[name]
        rows = fn(feeds)
        schemas[name] = T.StructType([T.StructField(key, T.LongType()), *rows.schema.fields])  # of a table without members
        dimensions.upsert_buckets(spark, paths[name], rows, key, nat, BEST_BY[name])
    return {name: dimensions.read_latest(spark, path, schemas.get(name)) for name, path in paths.items()}


def touched_dates(spark: SparkSession, layout: Layout, ids: DataFrame, gone: DataFrame, loaded):
    """A predicate on the event date: in the range (``loaded``), or a date of one of the sales ``ids`` in the index,
    or one that a landing day held before.  There is at most one date per calendar day to collect.

    Of the sales only dates outside the range are asked for.  Where the index holds none (a full load) they aren't looked up."""
    held = gone.select("sale_date").filter("sale_date IS NOT NULL")
    if loaded is not None:
        held = held.filter(~loaded(F.col("sale_date")))
    if loaded is None or not key_index.sale_entries(spark, layout.sale_index).filter(~loaded(F.col("sale_date"))).isEmpty():
        found = key_index.sale_entries(spark, layout.sale_index, ids).select("sale_date").filter("sale_date IS NOT NULL")
        held = held.unionByName(found if loaded is None else found.filter(~loaded(F.col("sale_date"))))
    dates = sorted(r[0] for r in held.distinct().collect())

    def touched(day: Column) -> Column:
        some = day.isin(dates) if dates else F.lit(False)
        return some if loaded is None else loaded(day) | some

    return touched


def days_holding(spark: SparkSession, layout: Layout, touched):
    """A predicate on the landing day: it landed deliveries for a touched date (at most one a calendar day)."""
    schema = T.StructType([T.StructField(LANDING_DAY, T.DateType()), T.StructField("sale_date", T.DateType())])
    found = slices.read(spark, layout.landed_dates, LANDING_DAY, schema).filter(touched(F.col("sale_date")))
    days = [r[0] for r in found.select(LANDING_DAY).distinct().collect()]
    named = [d for d in days if d is not None]
    return lambda day: (day.isin(named) if named else F.lit(False)) | (day.isNull() if None in days else F.lit(False))


def newest_deliveries(deliveries: DataFrame, moved: DataFrame) -> DataFrame:
    """One row per sale of the dates at hand, without the sales of which a
    newer delivery stands on another date (``moved``: the newest time of each
    sale that stands on several)."""
    own = unify.dedup_sales(deliveries.drop("sale_date")).withColumn("sale_date", S.sale_date("transaction_date"))
    newest = moved.select("sale_id", F.col("newest").alias("_newest"))
    return (own.join(newest, "sale_id", "left")
            .filter(F.col("_newest").isNull() | (F.col("_newest") <= F.col("transaction_date"))).select(*own.columns))


def settled_sales(sales: DataFrame, totals: DataFrame) -> DataFrame:
    """``settle_totals``; sales without a refund don't meet the totals, unless the refunded ones are too many to broadcast."""
    parts = key_index.halves(sales, "sale_id", totals.select(key_index.hashed("original_transaction_id")))
    if parts is None:
        return refund_ops.settle_totals(sales, totals)
    none = sales.sparkSession.createDataFrame([], totals.schema)
    return refund_ops.settle_totals(parts[0], totals).unionByName(refund_ops.settle_totals(parts[1], none))


def read_fact(spark: SparkSession, layout: Layout, dates=None, schema: T.StructType | None = None) -> DataFrame:
    return slices.read(spark, layout.fact_sales, "sale_date", schema, dates)


def read_revenue(spark: SparkSession, layout: Layout, dates=None) -> DataFrame:
    """Revenue per channel, from the summary the runs keep."""
    return summaries.revenue(spark, layout.revenue_by_date, dimensions.read_latest(spark, layout.dim_channels), dates)


def read_quarantine(spark: SparkSession, layout: Layout, feed: str) -> DataFrame:
    if feed in WHOLE:
        return quality.quarantined(dimensions.read_latest(spark, getattr(layout, f"staged_{feed}")))
    return staged(spark, layout, feed).filter(~F.col("is_valid"))


def main(argv: list[str] | None = None) -> dict:
    """spark-submit entry: load [start, end) of the landing zone under --root.

        spark-submit --py-files martlake.zip load_range.py --root <shared path> --start 2026-08-19 [--end 2026-08-20]

    ``--as-of`` (the fallback time and ingestion timestamp) defaults to the
    start of the range, not the wall clock, so a rerun writes the same rows.
    """
    import argparse
    import json

    p = argparse.ArgumentParser(description="Load a date range of the landing zone into the lakehouse")
    p.add_argument("--root", required=True, help="lakehouse root on shared storage")
    p.add_argument("--start", required=True, type=dt.date.fromisoformat)
    p.add_argument("--end", type=dt.date.fromisoformat, help="exclusive; default start + 1 day")
    p.add_argument("--as-of", type=dt.datetime.fromisoformat)
    p.add_argument("--no-web-refund-rule", action="store_true")
    args = p.parse_args(argv)
    end = args.end or args.start + dt.timedelta(days=1)
    as_of = args.as_of or dt.datetime.combine(args.start, dt.time())
    spark = SparkSession.builder.appName("martlake-load").getOrCreate()
    metrics = run_range(spark, Layout(args.root.rstrip("/")), args.start, end, as_of,
                        web_refund_rule=not args.no_web_refund_rule)
    print(json.dumps(metrics, default=str))
    return metrics
