"""Tables built on clean sales."""

from pyspark.sql import DataFrame, functions as F


def daily_region(sales: DataFrame) -> DataFrame:
    """Orders, units and revenue per day and region.

    Null dates and regions form groups of their own.  Revenue is summed as a
    decimal so that the result does not depend on the order of summation; NaN,
    infinite and oversized values become null there and do not count.
    """
    return sales.groupBy("order_date", "region").agg(
        F.count(F.lit(1)).alias("order_count"),
        F.sum("quantity").alias("units"),
        F.sum(F.col("revenue").try_cast("decimal(18,4)")).alias("revenue"),
    )


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once; empty when ``key`` is unique."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def enrich(sales: DataFrame, users: DataFrame) -> DataFrame:
    """Add the buyer's attributes; every sale is kept.

    ``users`` must be unique on ``user_id`` (see ``duplicate_keys``), else sales
    would be multiplied.  A buyer with very many sales, and sales without a buyer,
    are split by adaptive execution's skew join.
    """
    return sales.join(users, F.col("customer_id") == F.col("user_id"), "left").drop("user_id")
