"""Practice shop models: customers with their first and latest order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stg_customers(customers: DataFrame) -> DataFrame:
    return customers.select(F.col("id").alias("customer_id"), "first_name", "last_name")


def stg_orders(orders: DataFrame) -> DataFrame:
    return orders.select(F.col("id").alias("order_id"), F.col("user_id").alias("customer_id"),
                         "order_date", "status")


def stg_customer_orders(stg_orders_df: DataFrame) -> DataFrame:
    return stg_orders_df.groupBy("customer_id").agg(
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("most_recent_order_date"),
        F.count("order_id").alias("number_of_orders"))


def customers(stg_customers_df: DataFrame, stg_customer_orders_df: DataFrame) -> DataFrame:
    """One row per customer; without orders the dates are NULL and the count 0."""
    return (stg_customers_df.join(stg_customer_orders_df, "customer_id", "left")
            .select("customer_id", "first_name", "last_name", "first_order_date",
                    "most_recent_order_date",
                    F.coalesce("number_of_orders", F.lit(0).cast("bigint")).alias("number_of_orders")))
