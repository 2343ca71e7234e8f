"""Rule-driven data-quality split.

A rule names a fault.  A rule whose predicate is NULL does not fire; a row
is valid exactly when no rule fires, so the split is total (valid +
quarantined = input) under three-valued logic.  Validity is a plain boolean
conjunction (``holds``): it runs in generated code and its NOT NULL parts
reach the scan.  The fired rules' codes (``reasons array<string>``, in rule
order) are only computed for classified feeds.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlake import contracts as C

REASONS = "reasons"


@dataclass(frozen=True)
class Rule:
    code: str
    predicate: Callable[[], Column]  # built lazily: Columns need a live session


def _null(c: str, code: str | None = None) -> Rule:
    return Rule(code or f"null_{c}", lambda: F.col(c).isNull())


def web_order_rules() -> list[Rule]:
    return [
        _null("order_id"), _null("customer_id"), _null("product_id"), _null("quantity"),
        Rule("nonpositive_quantity", lambda: F.col("quantity") <= 0),
        Rule("cancelled", lambda: F.col("order_status") == C.CANCELLED_STATUS),
        Rule("null_status", lambda: F.col("order_status").isNull()),
    ]


def mkt_sale_rules() -> list[Rule]:
    return [
        _null("transaction_id"), _null("product_id"),
        _null("customer_email", "null_email"),
        _null("quantity"),
        Rule("nonpositive_quantity", lambda: F.col("quantity") <= 0),
        Rule("bad_timestamp", lambda: F.col("transaction_date").isNull()),
    ]


def refund_rules() -> list[Rule]:
    return [
        _null("refund_id"), _null("original_transaction_id"), _null("refund_amount"),
        Rule("negative_refund", lambda: F.col("refund_amount") < 0),
    ]


def product_rules() -> list[Rule]:
    return [_null("product_id"), Rule("negative_price", lambda: F.col("price") < 0)]


def customer_rules() -> list[Rule]:
    return [_null("customer_id")]


def holds(rules: list[Rule], parse_errors: str | None = None) -> Column:
    """No rule fires (and no parse error was recorded)."""
    ok = [~F.coalesce(r.predicate(), F.lit(False)) for r in rules]
    if parse_errors is not None:
        ok.append(F.size(parse_errors) == 0)
    return reduce(lambda a, b: a & b, ok)


def only_valid(df: DataFrame, rules: list[Rule], parse_errors: str | None = None) -> DataFrame:
    """The valid rows of a feed that is not classified."""
    out = df.filter(holds(rules, parse_errors))
    return out.drop(parse_errors) if parse_errors else out


def present(codes: list[Column]) -> Column:
    """The codes that aren't NULL, as an array; rows without any take no detour through a filter."""
    some = reduce(lambda a, b: a | b, (c.isNotNull() for c in codes))
    return F.when(some, F.filter(F.array(*codes), lambda x: x.isNotNull())).otherwise(F.array().cast("array<string>"))


def reasons(rules: list[Rule]) -> Column:
    return present([F.when(r.predicate(), F.lit(r.code)) for r in rules])


def classify(df: DataFrame, rules: list[Rule], parse_errors: str | None = None) -> DataFrame:
    """Attach ``reasons``; ``parse_errors`` (an array column made while
    reading text feeds) is prepended when present."""
    r = reasons(rules)
    if parse_errors is not None:
        r = F.concat(F.col(parse_errors), r)
    out = df.withColumn(REASONS, r)
    return out.drop(parse_errors) if parse_errors else out


def valid(classified: DataFrame) -> DataFrame:
    return classified.filter(F.size(REASONS) == 0).drop(REASONS)


def quarantined(classified: DataFrame) -> DataFrame:
    return classified.filter(F.size(REASONS) > 0)


def reason_counts(classified: DataFrame, feed: str) -> DataFrame:
    """Rows per reason code (a row with two reasons counts for both)."""
    return (classified.select(F.explode(REASONS).alias("reason"))
            .groupBy("reason").agg(F.count(F.lit(1)).alias("n_rows"))
            .select(F.lit(feed).alias("feed"), "reason", "n_rows"))


def split_totals(df: DataFrame, feed: str, rules: list[Rule], parse_errors: str | None = None) -> DataFrame:
    """One pass: input, valid and quarantined counts of a feed."""
    ok = holds(rules, parse_errors)
    return df.agg(
        F.count(F.lit(1)).alias("n_input"),
        F.count_if(ok).alias("n_valid"),
        F.count_if(~ok).alias("n_quarantined"),
    ).select(F.lit(feed).alias("feed"), "n_input", "n_valid", "n_quarantined")
