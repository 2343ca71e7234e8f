"""martlake — a retail revenue lakehouse on Spark.

Feeds (orders, products, customers, marketplace sales and refunds) are read
into contract-checked DataFrames, split into valid and quarantined rows,
conformed to one sales schema, de-duplicated, loaded into SCD1 dimensions
and a date-partitioned fact, and summarised by channel.  Every step is a
DataFrame -> DataFrame function; nothing is collected to the driver.
"""

__all__ = ["contracts", "session"]
