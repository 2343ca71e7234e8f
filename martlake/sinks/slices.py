"""Tables whose slices (dates, or other values of a column) are replaced.

Rows are written once, as plain Parquet with each date together, into a folder of
their own below ``<path>/data``; a manifest says which folder holds each
date's rows now, and how many dates were written there.  Replacing slices is
one commit (a new manifest version, a row per date): nothing is renamed or
deleted, readers see the old slices or the new ones, and a date that lost its
rows is simply not in the manifest.  Readers open only the folders of the
dates they ask for, and the files' statistics skip the other dates inside
them; only in folders that have lost a date since is each row held against
the manifest.
"""

from __future__ import annotations

import uuid
from typing import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlake.operators.dimensions import PACKED, read_latest, write_version

_DAY, _FOLDER = "_slice_day", "_slice_folder"


def replace(rows: DataFrame, path: str, column: str, scope: Callable[[Column], Column],
            metrics: dict[str, Column] | None = None, clustered: bool = False) -> dict:
    """Make the slices whose date is in ``scope`` equal to ``rows`` (which
    holds no other dates).  A date in scope without rows is emptied; NULL is
    a slice like any other.

    ``metrics`` (name -> aggregate) are observed on the rows as they are
    written and returned; so are the dates written (at most one a slice).
    They are taken in the writing stage itself, whose tasks count once
    however often they are tried again.

    ``clustered`` rows come in runs of one date each (from a landing zone's
    day folders, or a table's own slices) and are written as they come,
    without a shuffle or a sort."""
    spark = rows.sparkSession
    folder = uuid.uuid4().hex
    observed = Observation()
    ((rows if clustered else rows.hint("rebalance", column).sortWithinPartitions(column))
     .observe(observed, F.collect_set(column).alias(_DAY), F.count_if(F.col(column).isNull()).alias(_FOLDER),
              *[c.alias(name) for name, c in (metrics or {}).items()])
     .write.option("compression", PACKED).parquet(f"{path}/data/{folder}"))
    seen = dict(observed.get)
    days = [*seen.pop(_DAY), *[None] * (seen.pop(_FOLDER) > 0)]
    kind = rows.schema[column].dataType.simpleString()
    current = spark.createDataFrame([(d, folder, len(days)) for d in days], f"day {kind}, folder string, written int")
    manifest = read_latest(spark, f"{path}/manifest")
    if manifest is not None:
        current = manifest.filter(~F.coalesce(scope(F.col("day")), F.lit(False))).unionByName(current, allowMissingColumns=True)
    write_version(current.coalesce(1), f"{path}/manifest")  # a row per date
    return seen


def read(spark: SparkSession, path: str, column: str, schema: T.StructType | None = None,
         where: Callable[[Column], Column] | None = None) -> DataFrame | None:
    """The current rows (of the dates chosen by ``where``); None, or no rows
    of ``schema``, when there are none."""
    manifest = read_latest(spark, f"{path}/manifest")
    if manifest is None:
        return None if schema is None else spark.createDataFrame([], schema)
    chosen = F.lit(True) if where is None else F.coalesce(where(F.col("day")), F.lit(False))
    written = F.col("written") if "written" in manifest.columns else F.lit(None)
    folders = (manifest.groupBy("folder").agg(F.count_if(chosen).alias("chosen"), (F.count(F.lit(1)) == F.max(written)).alias("whole"))
               .filter("chosen > 0").collect())  # at most one per date
    if not folders:
        return None if schema is None else spark.createDataFrame([], schema)
    reader = spark.read if schema is None else spark.read.schema(schema)

    def rows(names: list[str]) -> DataFrame:
        found = reader.parquet(*[f"{path}/data/{f}" for f in sorted(names)])
        return found if where is None else found.filter(F.coalesce(where(F.col(column)), F.lit(False)))

    whole, cut = [r.folder for r in folders if r.whole], [r.folder for r in folders if not r.whole]
    if not cut:
        return rows(whole)
    current = F.broadcast(manifest.filter(chosen).select(F.col("day").alias(_DAY), F.col("folder").alias(_FOLDER)))
    inside = F.substring_index(F.substring_index(F.col("_metadata.file_path"), "/", -2), "/", 1)
    left = (rows(cut).withColumn("_in", inside)
            .join(current, (F.col("_in") == F.col(_FOLDER)) & F.col(column).eqNullSafe(F.col(_DAY)), "left_semi")
            .drop("_in"))
    return rows(whole).unionByName(left) if whole else left


def between(start, end) -> Callable[[Column], Column]:
    return lambda c: (c >= F.lit(start)) & (c < F.lit(end))
