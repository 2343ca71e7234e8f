"""Data contracts: schemas, keys, length bounds and defaults as data.

Raw contracts read every column that may carry dirt as a string, so a bad
value becomes a reason code instead of a silently inferred type.  Typed
contracts are what the rest of the lakehouse works with.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the source system's for right results.
# ---------------------------------------------------------------------------
WEB_SALE_PREFIX = "MYSQL-ORDER-"
WEB_CHANNEL = "Website"
WEB_SOURCE_SYSTEM = "MySQL"
CANCELLED_STATUS = "Cancelled"
REFUNDED_STATUS = "Refunded"
LANDING_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
# (channel_key, channel_name, channel_type) as seeded in the warehouse.
CHANNEL_SEED = [
    (1, "Website", "Internal"),
    (2, "Amazon", "Marketplace"),
    (3, "Flipkart", "Marketplace"),
]
# VARCHAR(n) bounds of the operational and warehouse tables.
VARCHAR_LIMITS = {
    "customers": {"first_name": 50, "last_name": 50, "email": 100, "phone": 20},
    "products": {"product_name": 100, "category": 50},
    "orders": {"order_status": 20},
    "dim_products": {"product_name": 100, "category": 50, "source_system": 50},
    "dim_customers": {"first_name": 50, "last_name": 50, "email": 100,
                      "phone": 20, "source_system": 50},
    "fact_sales": {"sale_id": 100},
}
# NOT NULL columns (primary keys included).
NOT_NULL = {
    "customers": ["customer_id", "first_name", "last_name", "email"],
    "products": ["product_id", "product_name", "category", "price"],
    "orders": ["order_id", "quantity", "total_amount"],
    "dim_products": ["product_key", "product_id", "product_name", "category",
                     "price", "source_system"],
    "dim_customers": ["customer_key", "customer_id", "source_system"],
    "fact_sales": ["sale_id", "quantity_sold", "sales_amount", "transaction_date"],
}
# Default product catalogue of each channel: the catalogue is shared.
DEFAULT_PRODUCT_SOURCE = "MySQL"
# ---------------------------------------------------------------------------

MONEY = T.DecimalType(10, 2)
TS = T.TimestampNTZType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


ORDERS = _schema(("order_id", T.LongType()), ("customer_id", T.LongType()),
                 ("product_id", T.LongType()), ("quantity", T.IntegerType()),
                 ("total_amount", MONEY), ("order_status", T.StringType()),
                 ("created_at", TS))
PRODUCTS = _schema(("product_id", T.LongType()), ("product_name", T.StringType()),
                   ("category", T.StringType()), ("price", MONEY))
CUSTOMERS = _schema(("customer_id", T.LongType()), ("first_name", T.StringType()),
                    ("last_name", T.StringType()), ("email", T.StringType()),
                    ("phone", T.StringType()))
MKT_SALES = _schema(("transaction_id", T.StringType()), ("product_id", T.LongType()),
                    ("customer_email", T.StringType()), ("customer_name", T.StringType()),
                    ("marketplace_name", T.StringType()), ("quantity", T.IntegerType()),
                    ("amount", MONEY), ("transaction_date", TS))
MKT_REFUNDS = _schema(("refund_id", T.StringType()), ("original_transaction_id", T.StringType()),
                      ("refund_amount", MONEY), ("customer_email", T.StringType()),
                      ("refund_date", TS))

CORRUPT_COLUMN = "_corrupt_record"


def raw_of(typed: T.StructType, corrupt: bool = False) -> T.StructType:
    """The landing contract of a typed contract: every column a string."""
    fields = [T.StructField(f.name, T.StringType(), True) for f in typed.fields]
    if corrupt:
        fields.append(T.StructField(CORRUPT_COLUMN, T.StringType(), True))
    return T.StructType(fields)


# Canonical unified sales (curated zone).
SALES = _schema(("sale_id", T.StringType()), ("product_id", T.LongType()),
                ("customer_id", T.LongType()), ("customer_email", T.StringType()),
                ("channel_name", T.StringType()), ("quantity_sold", T.IntegerType()),
                ("sales_amount", MONEY), ("transaction_date", TS))
SALES_COLUMNS = [f.name for f in SALES.fields]
# Newest event first, then the remaining columns: a total order for dedup.
SALES_RECENCY = ["transaction_date", "sales_amount", "quantity_sold", "product_id"]

CURATED_PRODUCTS = _schema(("product_id", T.LongType()), ("product_name", T.StringType()),
                           ("category", T.StringType()), ("price", MONEY),
                           ("source_system", T.StringType()))
CURATED_CUSTOMERS = _schema(("customer_id", T.LongType()), ("first_name", T.StringType()),
                            ("last_name", T.StringType()), ("email", T.StringType()),
                            ("phone", T.StringType()), ("source_system", T.StringType()))

DIM_PRODUCTS_KEY = ("product_key", ["product_id", "source_system"])
DIM_CUSTOMERS_KEY = ("customer_key", ["customer_id", "source_system"])

FACT_SALES = _schema(("sale_id", T.StringType()), ("product_key", T.LongType()),
                     ("customer_key", T.LongType()), ("channel_key", T.LongType()),
                     ("quantity_sold", T.IntegerType()), ("sales_amount", MONEY),
                     ("refund_amount", MONEY), ("transaction_date", TS),
                     ("ingestion_timestamp", TS), ("sale_date", T.DateType()))
FACT_COLUMNS = [f.name for f in FACT_SALES.fields]
