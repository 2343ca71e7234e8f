"""Golden values on the benchmark tables at every scale factor: split and
reason counts of the feeds, and the flagship revenue per channel."""

import pytest
from pyspark.sql import functions as F

from martlake.operators import dimensions
from martlake.plans import flows

# sf: (web rows, valid, mkt rows, mkt valid, refunds, emails, (email, channel) pairs, products, customers)
COUNTS = {
    "0.001": (6000, 4480, 412, 338, 41, 14, 28, 200, 150),
    "0.01": (60000, 45649, 3987, 3351, 383, 147, 294, 2000, 1500),
    "0.1": (600000, 455878, 39947, 33514, 3618, 1470, 2940, 20000, 15000),
}
# sf: (null product, null quantity, quantity <= 0, cancelled, null status, mkt null email, mkt quantity <= 0)
REASONS = {
    "0.001": (98, 88, 270, 269, 918, 32, 52),
    "0.01": (646, 659, 2313, 2918, 8598, 87, 558),
    "0.1": (6165, 6758, 23637, 28736, 86136, 810, 5738),
}
# sf: channel -> (orders, units, gross, refunds, net)
REVENUE = {
    "0.001": {"Amazon": (173, 643, 9334.68, 966.34, 8368.34), "Flipkart": (165, 564, 7896.63, 998.23, 6898.40),
              "Website": (3492, 85327, 199742084.01, 0.0, 199742084.01)},
    "0.01": {"Amazon": (1656, 5741, 78601.97, 7405.97, 71196.00), "Flipkart": (1695, 5950, 86403.65, 8934.69, 77468.96),
             "Website": (35478, 865046, 2041995694.13, 0.0, 2041995694.13)},
    "0.1": {"Amazon": (16867, 59084, 836855.91, 80778.33, 756077.58),
            "Flipkart": (16647, 58376, 834967.45, 74054.53, 760912.92),
            "Website": (352527, 8635014, 20302886153.59, 0.0, 20302886153.59)},
}


def _feeds(spark, sf):
    return flows.feeds_from_tables(spark, f"/root/testdata/sf{sf}")


@pytest.mark.parametrize("sf", sorted(COUNTS))
def test_feed_counts(spark, sf):
    f = _feeds(spark, sf)
    co, cs = flows.classified_orders(f), flows.classified_sales(f)
    ok = F.size("reasons") == 0
    o = co.agg(F.count(F.lit(1)), F.count_if(ok)).first()
    s = cs.agg(F.count(F.lit(1)), F.count_if(ok)).first()
    mkt = flows.unified_customers(f).filter("source_system <> 'MySQL'")
    got = (o[0], o[1], s[0], s[1], f.refunds.count(), mkt.select("email").distinct().count(),
           mkt.select("email", "source_system").distinct().count(), f.products.count(), f.customers.count())
    assert got == COUNTS[sf]


@pytest.mark.parametrize("sf", sorted(REASONS))
def test_reason_counts(spark, sf):
    f = _feeds(spark, sf)
    has = lambda c: F.count_if(F.array_contains("reasons", c))
    o = flows.classified_orders(f).agg(has("null_product_id"), has("null_quantity"), has("nonpositive_quantity"),
                                       has("cancelled"), has("null_status")).first()
    s = flows.classified_sales(f).agg(has("null_email"), has("nonpositive_quantity")).first()
    assert tuple(o) + tuple(s) == REASONS[sf]


@pytest.mark.parametrize("sf", sorted(REVENUE))
def test_flagship_revenue(spark, sf):
    r = flows.channel_revenue(flows.settled_sales(_feeds(spark, sf)), dimensions.channel_seed(spark))
    got = {row.channel_name: tuple(row)[1:] for row in r.collect()}
    assert set(got) == set(REVENUE[sf])
    for ch, want in REVENUE[sf].items():
        assert got[ch][:2] == want[:2]
        assert got[ch][2:] == pytest.approx(want[2:], abs=0.005)
