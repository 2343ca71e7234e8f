"""Incremental pick-up of landed marketplace files.

A Structured Streaming file source with ``Trigger.AvailableNow`` reads only
the files landed since the previous run (the checkpoint remembers which
were seen), processes them in bounded micro-batches and stops.

``run_available_now`` keeps folders of its own: each micro-batch (bounded by
``maxFilesPerTrigger``) is classified and staged once, conformed and written
by ``foreachBatch`` into folders named by the stream's id and its epoch with
overwrite: valid rows to the curated table, rows with reasons to the
quarantine.  A batch retried after a failure replaces its own output:
exactly-once at the table level.

``run_into_fact`` is stateful and ends in the lakehouse: deliveries that came
before, column for column, are dropped in the state store (kept for
``remember`` after they arrived; time is the arrival, so no row is ever too
late), and the sales that are new or changed go through the load's own steps,
which replace the fact's slices of their dates and no others.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlake import contracts as C
from martlake.operators import conform, quality, unify
from martlake.plans import runner
from martlake.sources.files import JSON_FILES, LANDING_DAY, PARSE_ERRORS, type_feed


def run_available_now(spark: SparkSession, landing: str, checkpoint: str, curated: str,
                      max_files_per_trigger: int = 1000, quarantine: str | None = None) -> None:
    """Process every NDJSON sales file under ``landing`` not seen before.
    Valid rows go to ``curated``, rows with reasons to ``quarantine``
    (default: a sibling folder of ``curated``), both per epoch."""
    quarantine = (quarantine or f"{curated.rstrip('/')}_quarantine").rstrip("/")
    stream = (spark.readStream.schema(C.raw_of(C.MKT_SALES, corrupt=True))
              .option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", C.CORRUPT_COLUMN)
              .option("maxFilesPerTrigger", max_files_per_trigger)
              .option("pathGlobFilter", JSON_FILES)
              .json(f"{landing.rstrip('/')}/*"))

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        # the stream's own id names its folder: another checkpoint starts at epoch 0 again
        stream_id = json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]
        here = f"stream={stream_id}/epoch={epoch_id}"
        classified = quality.classify(type_feed(batch, C.MKT_SALES), quality.mkt_sale_rules(), PARSE_ERRORS)
        staged = f"{quarantine}/staged/{here}"
        classified.write.mode("overwrite").parquet(staged)
        rows = spark.read.schema(classified.schema).parquet(staged)
        sales = conform.marketplace_sales(quality.valid(rows))
        (sales.withColumn("sale_date", F.to_date("transaction_date"))
         .write.mode("overwrite").parquet(f"{curated.rstrip('/')}/{here}"))
        quality.quarantined(rows).write.mode("overwrite").parquet(f"{quarantine}/{here}")

    q = (stream.writeStream.foreachBatch(per_batch)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def run_into_fact(spark: SparkSession, layout: runner.Layout, checkpoint: str, as_of: dt.datetime,
                  web_refund_rule: bool = True, max_files_per_trigger: int = 1000, remember: str = "30 days") -> None:
    """Pick up every marketplace sale landed below ``layout.landing_sales`` since the last time and bring the tables
    of ``layout`` up to date.

    A delivery that is forgotten (it arrived more than ``remember`` ago) and comes again is loaded again, which
    changes nothing.  A batch retried after a failure loads the same days again, with the same result."""
    schema = C.raw_of(C.MKT_SALES, corrupt=True)
    for key in ("year", "month", "day"):
        schema = schema.add(key, T.IntegerType())
    raw = (spark.readStream.schema(schema).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", C.CORRUPT_COLUMN).option("maxFilesPerTrigger", max_files_per_trigger)
           .option("pathGlobFilter", JSON_FILES).json(layout.landing_sales))
    day = F.make_date("year", "month", "day")
    rows = type_feed(raw.withColumn(LANDING_DAY, day).drop("year", "month", "day"), C.MKT_SALES)
    # a line that can't be read is known by its day, so that the day's quarantine is written
    dirty = F.size(PARSE_ERRORS) > 0
    keyed = (rows.withColumn("_dirty", F.when(dirty, F.concat_ws(",", F.col(PARSE_ERRORS), F.col(LANDING_DAY).cast("string"))))
             .withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", remember))
    fresh = keyed.dropDuplicatesWithinWatermark([*C.MKT_SALES.fieldNames(), "_dirty"])

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        path = f"{checkpoint}/fresh/epoch={epoch_id}"
        batch.select(F.col("transaction_id").alias("sale_id"), LANDING_DAY).write.mode("overwrite").parquet(path)
        new = spark.read.parquet(path)
        found = sorted(r[0] for r in new.select(LANDING_DAY).distinct().collect() if r[0] is not None)  # calendar days
        if found or not new.isEmpty():
            days = found or [dt.date(1, 1, 1)]  # rows that landed without a day are part of every run
            runner.run_ranges(spark, layout, [(d, d + dt.timedelta(days=1)) for d in days], as_of, web_refund_rule,
                              new.select("sale_id").filter("sale_id IS NOT NULL"))

    q = (fresh.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def read_quarantine(spark: SparkSession, curated: str) -> DataFrame:
    """The rows with reasons of every batch so far."""
    return spark.read.option("basePath", f"{curated.rstrip('/')}_quarantine").parquet(
        f"{curated.rstrip('/')}_quarantine/stream=*")


def read_curated(spark: SparkSession, curated: str) -> DataFrame:
    """All batches so far, one row per sale (the newest version wins)."""
    df = spark.read.parquet(curated).select(*C.SALES_COLUMNS)
    return unify.dedup_sales(df)


def with_web_sales(curated: DataFrame, valid_orders: DataFrame) -> DataFrame:
    """The batch load's curated sales: picked-up marketplace sales and the
    website's orders, one row per sale."""
    none = curated.withColumn(conform.RULE_REFUND, F.lit(0).cast(C.MONEY))
    return unify.dedup_sales(unify.union_all(conform.web_sales(valid_orders, None, True), none))
