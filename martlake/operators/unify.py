"""Union of channels and deterministic one-row-per-key selection.

``pick_one`` keeps, per key, the row that is greatest (or least) under a
total order: the given ordering columns first, then every remaining column
as tie-break.  It is a grouped ``max``/``min`` over a struct, which Spark
runs as partial + final aggregation: each map task reduces its share of a
key to one row before the shuffle, so a key holding a third of all rows
costs no more than any other key (no window has to sort a hot group in one
task).  The survivor does not depend on input order or partitioning.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlake import contracts as C

_PICK = "_pick"


def union_all(*frames: DataFrame) -> DataFrame:
    """Bag union by column name; a column missing on one side is NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def pick_one(df: DataFrame, keys: list[str], order: list[str], largest: bool = True) -> DataFrame:
    """One row per ``keys``.

    ``largest=True``: ORDER BY order..., rest... DESC NULLS LAST, first row.
    ``largest=False``: ORDER BY order..., rest... ASC NULLS LAST, first row.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    fields = order + rest
    if largest:
        # NULL is the smallest struct field value, so max() puts NULLs last.
        packed = F.struct(*[F.col(c) for c in fields])
        agg = F.max(packed)
    else:
        # Prefix each field with its NULL flag so min() puts NULLs last.
        packed = F.struct(*[e for i, c in enumerate(fields)
                            for e in (F.col(c).isNull().alias(f"_n{i}"), F.col(c))])
        agg = F.min(packed)
    picked = df.groupBy(*keys).agg(agg.alias(_PICK))
    return picked.select(*keys, *[F.col(f"{_PICK}.{c}").alias(c) for c in fields]).select(*df.columns)


def dedup_sales(sales: DataFrame) -> DataFrame:
    """One row per sale_id: newest transaction first, ties by amount,
    quantity, product and then every other column."""
    return pick_one(sales, ["sale_id"], C.SALES_RECENCY, largest=True)


def dedup_customers(customers: DataFrame, keys: list[str]) -> DataFrame:
    """One customer row per grain; ties by name, then the other columns."""
    return pick_one(customers, keys, ["first_name", "last_name"], largest=False)


def first_by(df: DataFrame, keys: list[str], order_col: str) -> DataFrame:
    """ROW_NUMBER() OVER (PARTITION BY keys ORDER BY order_col) = 1, made
    deterministic by breaking ties on the remaining columns."""
    return pick_one(df, keys, [order_col], largest=False)
