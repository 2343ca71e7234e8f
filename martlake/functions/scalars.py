"""Scalar column functions.  All are built-in Spark expressions (codegen'd,
no Python in the task), safe under ANSI mode: a bad value yields NULL and the
quality rules turn that NULL into a reason code."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from martlake import contracts as C

# 'yyyy-MM-dd HH:mm:ss' with an optional fraction of up to 6 digits.
_TS_PATTERN = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}(\.\d{1,6})?$"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_timestamp(c: str | Column) -> Column:
    """Parse 'yyyy-MM-dd HH:mm:ss[.ffffff]' into TIMESTAMP_NTZ; NULL if bad.

    Matching the text before a cast keeps the parse independent of the
    session time zone (no local-time round trip, no DST gaps).
    """
    c = col(c)
    return F.when(F.trim(c).rlike(_TS_PATTERN), F.trim(c).try_cast("timestamp_ntz"))


def ntz(value: dt.datetime | dt.date) -> Column:
    """A TIMESTAMP_NTZ literal built from text, so it does not depend on the
    session or Python time zone."""
    if not isinstance(value, dt.datetime):
        value = dt.datetime.combine(value, dt.time())
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def format_timestamp(c: str | Column, with_fraction: bool = False) -> Column:
    """Render a timestamp as landing text ('yyyy-MM-dd HH:mm:ss')."""
    fmt = C.LANDING_TIMESTAMP_FORMAT + (".SSSSSS" if with_fraction else "")
    return F.date_format(col(c), fmt)


def try_long(c: str | Column) -> Column:
    return F.trim(col(c)).try_cast("bigint")


def try_int(c: str | Column) -> Column:
    return F.trim(col(c)).try_cast("int")


def web_sale_id(order_id: str | Column) -> Column:
    return F.concat(F.lit(C.WEB_SALE_PREFIX), col(order_id).cast("string"))


def identity_md5(email: str | Column) -> Column:
    """60-bit customer id from the e-mail: the first 15 hex digits of md5.

    Wide enough that distinct e-mails practically never collide, never
    negative, and reproducible outside Spark.
    """
    return F.conv(F.substring(F.md5(col(email)), 1, 15), 16, 10).cast("bigint")


def identity_murmur(email: str | Column) -> Column:
    """The 32-bit Murmur3 form abs(hash(email)), computed in bigint so the
    absolute value of INT_MIN does not overflow under ANSI mode."""
    return F.abs(F.hash(col(email)).cast("bigint"))


def first_name(full_name: str | Column) -> Column:
    """First space-separated token (NULL for a NULL name)."""
    return F.get(F.split(col(full_name), " "), 0)


def last_name(full_name: str | Column) -> Column:
    """Second token, '' when absent; later tokens are dropped."""
    return F.coalesce(F.get(F.split(col(full_name), " "), 1), F.lit(""))


def sale_date(ts: str | Column) -> Column:
    return F.to_date(col(ts))


def with_partition_columns(df, ts: str = "transaction_date"):
    """Add sale_date (the partition column) and year/month/day."""
    return (df.withColumn("sale_date", sale_date(ts))
              .withColumn("year", F.year(ts))
              .withColumn("month", F.month(ts))
              .withColumn("day", F.dayofmonth(ts)))
