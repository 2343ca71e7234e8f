"""SCD type-1 dimensions with stable surrogate keys.

Parquet tables cannot be updated in place, and a table cannot be
overwritten while it is being read, so a dimension is a folder of versions
``<path>/version=<n>``; an upsert writes version n+1 from version n and the
incoming rows, and readers take the newest committed version.

Surrogate keys are dense, start after the current maximum, and go to new
members in natural-key order.  They are assigned without any window over
the whole data: new members are range-partitioned by natural key and
checkpointed (so partition contents are fixed even if an executor is lost),
each partition's row count is computed (one row per partition), and a row's
key is ``max_key + rows in earlier partitions + its index in its own
partition``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martlake import contracts as C
from martlake.operators.unify import first_by
from martlake.session import scratch_path, shared_root

_IN = "_incoming"
#: Codec of the written tables.
PACKED = "zstd"


# --------------------------------------------------------------------------
# Versioned tables
# --------------------------------------------------------------------------
def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def committed_versions(spark: SparkSession, path: str) -> list[int]:
    """Versions under ``path`` that finished writing (have _SUCCESS)."""
    fs, p, jvm = _fs(spark, path)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if name.startswith("version=") and fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
            out.append(int(name.split("=", 1)[1]))
    return sorted(out)


def read_latest(spark: SparkSession, path: str, schema=None) -> DataFrame | None:
    """The newest committed version, or the current rows of a table of buckets."""
    versions = committed_versions(spark, path)
    if not versions:
        if committed_versions(spark, f"{path}/manifest"):
            rows = _slices().read(spark, path, BUCKET)
            if rows is not None:
                return rows.drop(BUCKET)
        return None if schema is None else spark.createDataFrame([], schema)
    return spark.read.parquet(f"{path}/version={versions[-1]}")


def write_version(df: DataFrame, path: str) -> int:
    spark = df.sparkSession
    versions = committed_versions(spark, path)
    n = (versions[-1] + 1) if versions else 1
    df.write.mode("overwrite").option("compression", PACKED).parquet(f"{path}/version={n}")
    return n


# --------------------------------------------------------------------------
# Surrogate keys
# --------------------------------------------------------------------------
def assign_keys(new_members: DataFrame, natural_keys: list[str], key_col: str,
                start_after: int = 0, num_partitions: int | None = None) -> DataFrame:
    """Dense keys start_after+1 .. start_after+n in natural-key order."""
    spark = new_members.sparkSession
    shared_root(spark)  # make sure a checkpoint folder is registered
    # Without an explicit count AQE may merge adjacent (small) range
    # partitions, which keeps the order: few new members, few files.
    spread = (new_members.repartitionByRange(num_partitions, *natural_keys) if num_partitions
              else new_members.repartitionByRange(*natural_keys))
    ranged = spread.sortWithinPartitions(*natural_keys).checkpoint(eager=True)
    # monotonically_increasing_id = (partition index << 33) + row index in it
    indexed = (ranged.withColumn("_pid", F.spark_partition_id())
               .withColumn("_row", F.monotonically_increasing_id()
                           - F.shiftleft(F.spark_partition_id().cast("bigint"), 33)))
    # One row per partition: bounded by the partition count, so the window
    # and the broadcast below are over partition counts, never over data.
    counts = indexed.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    offsets = counts.select(
        "_pid",
        (F.sum("_cnt").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)))
        .alias("_before"))
    keyed = indexed.join(F.broadcast(offsets), "_pid")
    key = F.lit(start_after) + F.coalesce(F.col("_before"), F.lit(0)) + F.col("_row") + 1
    return keyed.select(key.cast("bigint").alias(key_col), *new_members.columns)


def max_key(dim: DataFrame | None, key_col: str) -> int:
    if dim is None:
        return 0
    row = dim.agg(F.max(key_col)).first()  # a single scalar
    return int(row[0]) if row and row[0] is not None else 0


# --------------------------------------------------------------------------
# SCD1 upsert
# --------------------------------------------------------------------------
def scd1_upsert(current: DataFrame | None, incoming: DataFrame, key_col: str,
                natural_keys: list[str], order_col: str | None = None) -> DataFrame:
    """MERGE semantics on the natural key: matched rows take every incoming
    attribute (NULLs included, as UPDATE SET t.c = s.c does), keys are kept;
    unmatched incoming rows are inserted with new keys; untouched rows stay.

    ``incoming`` is first reduced to one row per natural key (the least by
    ``order_col``, ties by the other columns).  A row without a natural key
    names no member and is left out (its feed quarantines it).
    """
    attrs = [c for c in incoming.columns if c not in natural_keys and c != key_col]
    incoming = incoming.dropna(subset=natural_keys)
    src = first_by(incoming, natural_keys, order_col or attrs[0])
    if current is None:
        return assign_keys(src.select(*natural_keys, *attrs), natural_keys, key_col, 0)
    top = max_key(current, key_col)
    # the incoming rows are reduced once and staged: both joins read the table
    staged = scratch_path(current.sparkSession, "incoming")
    src.select(*natural_keys, *attrs).write.parquet(staged)
    src = current.sparkSession.read.schema(src.select(*natural_keys, *attrs).schema).parquet(staged)
    t = current.select(key_col, *natural_keys, *[F.col(a).alias(f"_t_{a}") for a in attrs])
    matched_or_kept = t.join(src.withColumn(_IN, F.lit(True)), natural_keys, "left").select(
        key_col, *natural_keys,
        *[F.when(F.col(_IN), F.col(a)).otherwise(F.col(f"_t_{a}")).alias(a) for a in attrs])
    inserted = src.join(current.select(*natural_keys), natural_keys, "left_anti").select(*natural_keys, *attrs)
    new_keys = assign_keys(inserted, natural_keys, key_col, top)
    return matched_or_kept.unionByName(new_keys)


# --------------------------------------------------------------------------
# SCD1 upsert of a table of buckets
# --------------------------------------------------------------------------
BUCKET, BUCKETS = "_bucket", 256


def _slices():
    from martlake.sinks import slices  # which reads and writes its manifest with the functions above

    return slices


def upsert_buckets(spark: SparkSession, path: str, incoming: DataFrame, key_col: str, natural_keys: list[str],
                   order_col: str | None = None) -> list[int]:
    """``scd1_upsert`` into a table split by hash bucket of the natural key: incoming rows that say what a
    member says already touch nothing, and only buckets with a new or changed member are written again.  One commit (a
    new manifest); returns the buckets written (BUCKETS at most)."""
    slices = _slices()
    attrs = [c for c in incoming.columns if c not in natural_keys and c != key_col]
    src = first_by(incoming.dropna(subset=natural_keys), natural_keys, order_col or attrs[0]).select(*natural_keys, *attrs)
    src = src.withColumn(BUCKET, F.pmod(F.xxhash64(*natural_keys), F.lit(BUCKETS)).cast("int"))
    if read_latest(spark, path) is None:
        first = assign_keys(src, natural_keys, key_col, 0)
        slices.replace(first, path, BUCKET, lambda b: F.lit(True))
        written = slices.read(spark, path, BUCKET, first.schema)
        return sorted(r[0] for r in written.select(BUCKET).distinct().collect())
    current = slices.read(spark, path, BUCKET)
    own = current.select(key_col, *natural_keys, *[F.col(a).alias(f"_t_{a}") for a in attrs])
    same = F.lit(True)
    for a in attrs:
        same = same & F.col(a).eqNullSafe(F.col(f"_t_{a}"))
    differs = src.join(own, natural_keys, "left").filter(F.col(key_col).isNull() | ~same).select(key_col, *src.columns)
    staged = scratch_path(spark, "changed")
    differs.write.parquet(staged)
    changed = spark.read.schema(differs.schema).parquet(staged)
    numbers = sorted(r[0] for r in changed.select(BUCKET).distinct().collect())
    if not numbers:
        return []
    def touched(b):
        return b.isin(numbers)

    new = assign_keys(changed.filter(F.col(key_col).isNull()).drop(key_col), natural_keys, key_col, max_key(current, key_col))
    renewed = changed.filter(F.col(key_col).isNotNull())
    kept = slices.read(spark, path, BUCKET, current.schema, touched).join(renewed.select(key_col), key_col, "left_anti")
    columns = [key_col, *natural_keys, *attrs, BUCKET]
    rows = kept.select(*columns).unionByName(renewed.select(*columns)).unionByName(new.select(*columns))
    slices.replace(rows, path, BUCKET, touched)
    return numbers


# --------------------------------------------------------------------------
# Channels
# --------------------------------------------------------------------------
def channel_seed(spark: SparkSession) -> DataFrame:
    rows = [(k, n, t, C.DEFAULT_PRODUCT_SOURCE) for k, n, t in C.CHANNEL_SEED]
    return spark.createDataFrame(
        rows, "channel_key bigint, channel_name string, channel_type string, product_source string")


def channels(spark: SparkSession, observed_sales: DataFrame, current: DataFrame | None = None) -> DataFrame:
    """The current channel dimension (the seed when there is none yet) plus
    every channel seen in the sales that it lacks; a new marketplace gets the
    next key and existing keys never change.  The distinct channel names are
    aggregated map-side first; there are a handful of them."""
    base = current if current is not None else channel_seed(spark)
    seen = observed_sales.select("channel_name").filter(F.col("channel_name").isNotNull()).distinct()
    new = seen.join(F.broadcast(base.select("channel_name")), "channel_name", "left_anti")
    if new.isEmpty():  # the usual case: every channel is known
        return base
    keyed = assign_keys(new, ["channel_name"], "channel_key", max_key(base, "channel_key"))
    extra = keyed.select("channel_key", "channel_name", F.lit("Marketplace").alias("channel_type"),
                         F.lit(C.DEFAULT_PRODUCT_SOURCE).alias("product_source"))
    return base.unionByName(extra)


def upsert_channels(spark: SparkSession, path: str, observed_sales: DataFrame) -> DataFrame:
    """Versioned channel dimension: seeded on first use, extended with new
    channels, read back from the newest committed version."""
    current = read_latest(spark, path)
    merged = channels(spark, observed_sales, current)
    if current is None or merged is not current:
        write_version(merged, path)
    return read_latest(spark, path)
