"""The clean step: drop rows without an id, type the columns, derive two more."""

from pyspark.sql import DataFrame, functions as F

from millrace.functions import casts


def drop_null(df: DataFrame, column: str = "order_id") -> DataFrame:
    return df.filter(F.col(column).isNotNull())


def clean_sales(df: DataFrame, drop_source_total: bool = False) -> DataFrame:
    """Raw text sales to typed sales.

    ``quantity`` and ``unit_price`` are replaced in place, ``order_date`` and
    ``revenue`` are appended.  The upstream ``total_price`` is kept as text but
    never used; ``drop_source_total`` removes it.
    """
    typed = drop_null(df).withColumns(
        {
            "unit_price": casts.to_double("unit_price"),
            "quantity": casts.to_int("quantity"),
            "order_date": casts.to_date("order_timestamp"),
        }
    )
    priced = typed.withColumn("revenue", F.col("quantity") * F.col("unit_price"))
    return priced.drop("total_price") if drop_source_total else priced
