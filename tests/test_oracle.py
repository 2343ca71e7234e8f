"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as entry
from oracle_compare import compare, duck

NAMES = sorted(entry.queries())
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, sf_dir, name):
    fn = entry.queries()[name]
    if name not in ORACLE:
        assert fn(spark, sf_dir).count() > 0
        return
    info = compare(spark, con, name, fn, ORACLE[name], sf_dir)
    assert info["match"], info


def test_entry_runs(spark):
    rows = entry.entry(spark).collect()
    assert [r.channel_name for r in rows] == ["Website", "Amazon", "Flipkart"]
    assert rows[0].total_orders == 3492


@pytest.mark.parametrize("name", ["scalar_parse_timestamp", "scalar_timestamp_fallback", "fact_defaults",
                                  "src_extract_orders_day", "src_csv_orders", "incremental_sales"])
def test_results_do_not_depend_on_session_time_zone(spark, con, sf_dir, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        info = compare(spark, con, name, entry.queries()[name], ORACLE[name], sf_dir)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert info["match"], info


def test_driver_contract_shape():
    from martlake.plans.catalog import QUERIES
    q, o = entry.queries(), entry.oracle_sql()
    assert len(QUERIES) == 74 and set(o) <= set(q) and set(QUERIES) <= set(o)
    assert all(callable(fn) for fn in q.values()) and all(isinstance(s, str) and s.strip() for s in o.values())
