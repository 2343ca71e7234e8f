"""Seed feeds of the operational system and the marketplace mock, as
literal rows, for golden-value tests."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from martlake import contracts as C

# Operational seed (products, customers, orders) and the
# marketplace mock records (three sales and one refund per day).
PRODUCTS = [
    (1, "UltraBook Pro 15", "Electronics", "1200.00"),
    (2, "SmartPhone X10", "Electronics", "800.00"),
    (3, "Wireless Noise-Cancelling Headphones", "Audio", "250.00"),
    (4, "FitLife Smartwatch", "Wearables", "150.00"),
    (5, "TabLite 10-inch", "Electronics", "350.00"),
]
CUSTOMERS = [
    (1, "Aarav", "Sharma", "aarav.sharma@email.com", "9876543210"),
    (2, "Diya", "Patel", "diya.patel@email.com", "9876543211"),
    (3, "Vivaan", "Gupta", "vivaan.gupta@email.com", "9876543212"),
    (4, "Ananya", "Iyer", "ananya.iyer@email.com", "9876543213"),
    (5, "Kabir", "Singh", "kabir.singh@email.com", "9876543214"),
    (6, "Ishaan", "Reddy", "ishaan.reddy@email.com", "9876543215"),
    (7, "Myra", "Nair", "myra.nair@email.com", "9876543216"),
    (8, "Arjun", "Mehta", "arjun.mehta@email.com", "9876543217"),
    (9, "Kiara", "Joshi", "kiara.joshi@email.com", "9876543218"),
    (10, "Sai", "Prasad", "sai.prasad@email.com", "9876543219"),
]
ORDERS = [
    (1001, 1, 1, 1, "1200.00", "Completed", "2026-08-19 10:15:00"),
    (1002, 2, 3, 2, "500.00", "Completed", "2026-08-19 11:45:00"),
    (1003, 3, 4, 1, "150.00", "Completed", "2026-08-19 14:30:00"),
    (1004, 4, 2, 1, "800.00", "Refunded", "2026-08-19 16:00:00"),
    (1099, 7, 3, 1, "250.00", "Cancelled", "2026-08-19 17:30:00"),
    (1005, 5, 5, 2, "700.00", "Completed", "2026-08-20 09:30:00"),
    (1006, 6, 1, 1, "1200.00", "Completed", "2026-08-20 12:15:00"),
    (1007, 7, 3, 1, "250.00", "Cancelled", "2026-08-20 15:45:00"),
    (1008, 8, 2, 1, "800.00", "Completed", "2026-08-20 17:00:00"),
    (1009, 9, 4, 3, "450.00", "Completed", "2026-08-21 10:00:00"),
    (1010, 10, 5, 1, "350.00", "Completed", "2026-08-21 11:30:00"),
    (1011, 1, 2, 1, "800.00", "Completed", "2026-08-21 13:00:00"),
    (1012, 2, 1, 1, "1200.00", "Completed", "2026-08-21 16:20:00"),
    (1013, 3, 3, 1, "250.00", "Completed", "2026-08-22 09:00:00"),
    (1014, 4, 5, 2, "700.00", "Completed", "2026-08-22 14:10:00"),
    (1015, 5, 4, 1, "150.00", "Refunded", "2026-08-22 15:30:00"),
]
DATES = ["2026-08-19", "2026-08-20", "2026-08-21", "2026-08-22"]
MKT_SALES_PER_DAY = [
    ("MKT-SALE-AMZ-{d}-101", "Amazon", 1, 1, "1200.00", "John Doe", "john.doe@email.com", "10:30:00"),
    ("MKT-SALE-FLP-{d}-102", "Flipkart", 3, 2, "500.00", "Jane Smith", "jane.smith@email.com", "14:15:00"),
    ("MKT-SALE-AMZ-{d}-103", "Amazon", 4, 1, "150.00", "Bob Johnson", "bob.johnson@email.com", "18:45:00"),
]
MKT_REFUNDS_PER_DAY = [
    ("MKT-REF-{d}-201", "MKT-SALE-AMZ-{d}-103", "150.00", "bob.johnson@email.com", "19:30:00"),
]


def _ts(s: str) -> dt.datetime:
    return dt.datetime.strptime(s, "%Y-%m-%d %H:%M:%S")


def feeds(spark):
    from martlake.plans.flows import Feeds
    orders = spark.createDataFrame(
        [(o, c, p, q, Decimal(a), s, _ts(t)) for o, c, p, q, a, s, t in ORDERS], C.ORDERS)
    products = spark.createDataFrame([(i, n, c, Decimal(p)) for i, n, c, p in PRODUCTS], C.PRODUCTS)
    customers = spark.createDataFrame(CUSTOMERS, C.CUSTOMERS)
    sales = spark.createDataFrame(
        [(tid.format(d=d), p, e, nm, m, q, Decimal(a), _ts(f"{d} {t}"))
         for d in DATES for tid, m, p, q, a, nm, e, t in MKT_SALES_PER_DAY], C.MKT_SALES)
    refunds = spark.createDataFrame(
        [(rid.format(d=d), tid.format(d=d), Decimal(a), e, _ts(f"{d} {t}"))
         for d in DATES for rid, tid, a, e, t in MKT_REFUNDS_PER_DAY], C.MKT_REFUNDS)
    return Feeds(orders=orders, sales=sales, refunds=refunds, products=products, customers=customers)
