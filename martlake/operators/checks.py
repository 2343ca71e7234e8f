"""Declared constraints checked as DataFrames of violations: foreign keys,
uniqueness, NOT NULL and VARCHAR(n) bounds.  Each check is one aggregation
or anti-join pass; nothing is collected."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fk_orphans(child: DataFrame, id_col: str,
               references: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Child rows whose non-NULL foreign key has no parent (left anti join
    per reference; a NULL reference is not a violation)."""
    parts = []
    for fk, (parent, pk) in references.items():
        keys = parent.select(F.col(pk).alias(fk)).distinct()  # copies of a key collapse map-side
        orphan = child.filter(F.col(fk).isNotNull()).join(keys, fk, "left_anti")
        parts.append(orphan.select(F.col(id_col), F.lit(fk).alias("fk_column")))
    return reduce(DataFrame.unionByName, parts)


def duplicate_keys(df: DataFrame, keys: list[str], members: list[str] | None = None) -> DataFrame:
    """Keys held by more than one row (or by more than one distinct
    ``members`` combination)."""
    if members:
        n = F.count_distinct(F.struct(*members))
    else:
        n = F.count(F.lit(1))
    return df.groupBy(*keys).agg(n.alias("n_rows")).filter(F.col("n_rows") > 1)


def null_counts(tables: dict[str, DataFrame], not_null: dict[str, list[str]]) -> DataFrame:
    """NULLs per NOT NULL column; one aggregation pass per table."""
    parts = []
    for name, df in tables.items():
        cols = [c for c in not_null.get(name, []) if c in df.columns]
        agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
        rows = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_null"))
                                  for c in cols]))
        parts.append(agg.select(rows.alias("r")).select(
            F.lit(name).alias("table_name"), "r.column_name", "r.n_null"))
    return reduce(DataFrame.unionByName, parts)


def length_violations(tables: dict[str, DataFrame], limits: dict[str, dict[str, int]]) -> DataFrame:
    """Longest value and count of values over the VARCHAR(n) bound, per
    bounded column; one aggregation pass per table."""
    parts = []
    for name, df in tables.items():
        bounds = {c: n for c, n in limits.get(name, {}).items() if c in df.columns}
        aggs = []
        for c, n in bounds.items():
            aggs += [F.max(F.length(c)).cast("bigint").alias(f"max_{c}"),
                     F.count_if(F.length(c) > n).alias(f"over_{c}")]
        agg = df.agg(*aggs)
        rows = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(n).cast("bigint").alias("max_allowed"),
                                            F.col(f"max_{c}").alias("max_length"),
                                            F.col(f"over_{c}").alias("n_over"))
                                  for c, n in bounds.items()]))
        parts.append(agg.select(rows.alias("r")).select(
            F.lit(name).alias("table_name"), "r.column_name", "r.max_allowed", "r.max_length", "r.n_over"))
    return reduce(DataFrame.unionByName, parts)
