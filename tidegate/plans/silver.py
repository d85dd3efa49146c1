"""Cleaning of the three feeds.

The ``tidy`` steps work row by row, so they also run directly on a stream. The ``clean`` plans drop copies
inside a commit first, which costs a shuffle. A merge by key makes that unnecessary: it keeps one change
per key and sequence value, and copies are equal changes. So tables that are merged next are only tidied.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import normalise_name, parse_date, parse_timestamp, title_case
from ..operators.changes import dedup_within_commit


def tidy_customers(rows: DataFrame) -> DataFrame:
    return (rows.withColumn("customer_name", normalise_name("customer_name"))
                .withColumn("Date_of_birth", parse_date("date_of_birth")))


def tidy_products(rows: DataFrame) -> DataFrame:
    return (rows.withColumn("product_name", title_case("product_name"))
                .withColumn("expiry_date", parse_date("expiry_date")))


def tidy_orders(rows: DataFrame) -> DataFrame:
    known = rows.filter(F.col("customer_id").isNotNull() & F.col("product_id").isNotNull())
    return (known.withColumn("total_amount", F.col("amount").cast("double") * F.col("quantity").cast("int"))
                 .withColumn("Order_date", parse_timestamp("order_date")))


def clean_customers(changes: DataFrame) -> DataFrame:
    return tidy_customers(dedup_within_commit(changes))


def clean_products(changes: DataFrame) -> DataFrame:
    return tidy_products(dedup_within_commit(changes))


def clean_orders(changes: DataFrame) -> DataFrame:
    return tidy_orders(dedup_within_commit(changes))
