"""Contract-checked file sources: CSV and NDJSON landing zones, staged
Parquet, dated slices and empty fallbacks.

Schemas are never inferred: a landing feed is read with its raw contract
(strings where dirt may occur) and then typed with ``try_cast``-style
parsers; a value present in the text but not parseable is recorded in
``_parse_errors`` as ``bad_<column>``, which the quality split turns into a
reason code.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlake import contracts as C
from martlake.functions import scalars as S
from martlake.operators import quality

PARSE_ERRORS = "_parse_errors"
#: Landing files, plain or packed.
CSV_FILES, JSON_FILES = "*.{csv,csv.gz}", "*.{json,json.gz}"


def _typed(c: str, dtype: T.DataType):
    if isinstance(dtype, T.LongType):
        return S.try_long(c)
    if isinstance(dtype, T.IntegerType):
        return S.try_int(c)
    if isinstance(dtype, T.DecimalType):
        return F.trim(F.col(c)).try_cast(dtype)
    if isinstance(dtype, T.TimestampNTZType):
        return S.parse_timestamp(c)
    if isinstance(dtype, T.DateType):
        return F.trim(F.col(c)).try_cast("date")
    return F.col(c)


def type_feed(raw: DataFrame, typed: T.StructType) -> DataFrame:
    """Typed columns of ``typed`` plus ``_parse_errors array<string>``."""
    cols, errs = [], []
    for f in typed.fields:
        t = _typed(f.name, f.dataType)
        cols.append(t.alias(f.name))
        if not isinstance(f.dataType, T.StringType):
            errs.append(F.when(F.col(f.name).isNotNull() & t.isNull(), F.lit(f"bad_{f.name}")))
    if C.CORRUPT_COLUMN in raw.columns:
        errs.insert(0, F.when(F.col(C.CORRUPT_COLUMN).isNotNull(), F.lit("corrupt_record")))
    errors = quality.present(errs) if errs else F.array().cast("array<string>")
    extra = [c for c in raw.columns if c not in typed.names and c != C.CORRUPT_COLUMN]
    return raw.select(*cols, errors.alias(PARSE_ERRORS), *extra)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """The fallback of a feed with no files: no rows, the declared schema."""
    return spark.createDataFrame([], schema)


def _empty_typed(spark: SparkSession, typed: T.StructType) -> DataFrame:
    return empty(spark, T.StructType(typed.fields + [
        T.StructField(PARSE_ERRORS, T.ArrayType(T.StringType()), True)]))


def read_csv_feed(spark: SparkSession, path: str, typed: T.StructType) -> DataFrame:
    """A CSV landing folder (header row, 'yyyy-MM-dd HH:mm:ss' times, empty
    field = NULL) typed by its contract; empty fallback if absent.  A
    malformed line becomes reason ``corrupt_record``."""
    if not path_exists(spark, path):
        return _empty_typed(spark, typed)
    return type_feed(_csv(spark, typed).csv(path), typed)


def _csv(spark: SparkSession, typed: T.StructType):
    """A line with more or fewer fields than the contract keeps its text in
    ``_corrupt_record`` (all fields are read: a pruned line can't be told)."""
    return (spark.read.schema(C.raw_of(typed, corrupt=True)).option("header", True)
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", C.CORRUPT_COLUMN)
            .option("columnPruning", False).option("pathGlobFilter", CSV_FILES))


def read_ndjson_feed(spark: SparkSession, path: str, typed: T.StructType,
                     recursive: bool = True, glob: str = JSON_FILES) -> DataFrame:
    """An NDJSON landing folder, all depths below it; a malformed line keeps
    its text in ``_corrupt_record`` and becomes reason ``corrupt_record``."""
    if not path_exists(spark, path):
        return _empty_typed(spark, typed)
    raw = (spark.read.schema(C.raw_of(typed, corrupt=True))
           .option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", C.CORRUPT_COLUMN)
           .option("recursiveFileLookup", recursive)
           .option("pathGlobFilter", glob).json(path))
    return type_feed(raw, typed)


LANDING_DAY = "_landing_day"


def read_dated_feed(spark: SparkSession, path: str, typed: T.StructType, fmt: str = "json",
                    start: dt.date | None = None, end: dt.date | None = None, days=None) -> DataFrame:
    """A landing folder keyed ``year=YYYY/month=MM/day=DD`` (NDJSON or CSV),
    reading only the day folders in [start, end) (either bound may be open),
    or those that ``days`` chooses (a predicate on the date), plus the folder of rows that had no date, which the quality split
    quarantines.  ``_landing_day`` carries each row's folder date (NULL for
    the undated folder).

    The day is a predicate on the partition columns, for every range and
    whether or not the folder names are zero-padded: the other days' files
    are skipped (``PartitionFilters``)."""
    empty_out = _empty_typed(spark, typed).withColumn(LANDING_DAY, F.lit(None).cast("date"))
    if not path_exists(spark, path):
        return empty_out
    if fmt == "json":
        raw = (spark.read.schema(C.raw_of(typed, corrupt=True)).option("mode", "PERMISSIVE")
               .option("columnNameOfCorruptRecord", C.CORRUPT_COLUMN).option("pathGlobFilter", JSON_FILES).json(path))
    else:
        raw = _csv(spark, typed).csv(path)
    if "year" not in raw.columns:  # nothing has landed below it
        return empty_out
    day = F.make_date("year", "month", "day")
    keep = F.lit(True)
    if start is not None:
        keep = keep & (day >= F.lit(start))
    if end is not None:
        keep = keep & (day < F.lit(end))
    if days is not None:
        keep = keep & days(day)
    raw = raw.filter(F.col("year").isNull() | keep).withColumn(LANDING_DAY, day).drop("year", "month", "day")
    return type_feed(raw, typed)


def read_dated_ndjson_feed(spark: SparkSession, path: str, typed: T.StructType,
                           start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    return read_dated_feed(spark, path, typed, "json", start, end).drop(LANDING_DAY)


def read_parquet_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """A Parquet table, or None when nothing has been written there yet."""
    if not path_exists(spark, path):
        return None
    try:
        return spark.read.parquet(path)
    except AnalysisException:  # the folder holds no data file yet
        return None


def read_dated_slice(spark: SparkSession, path: str, start: dt.date, end: dt.date,
                     date_col: str = "dt", fmt: str = "parquet") -> DataFrame:
    """Rows of the date partitions in [start, end): a predicate on the
    partition column, so only those folders are listed and read."""
    df = spark.read.format(fmt).load(path)
    return df.filter((F.col(date_col) >= F.lit(start)) & (F.col(date_col) < F.lit(end)))


def read_staged_parquet(spark: SparkSession, path: str, file_schema: T.StructType,
                        casts: T.StructType) -> DataFrame:
    """COPY INTO-style staging: read the ``*.parquet`` files below ``path``
    with an explicit file schema (a column absent from the files reads as
    NULL) and cast every column to its staging type."""
    df = (spark.read.schema(file_schema).option("pathGlobFilter", "*.parquet")
          .option("recursiveFileLookup", True).parquet(path))
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in casts.fields])
