"""The star-schema tables, seen as the datasets this library works on.

Sales are line items with their order, buyer, region and part, as CSV text.  Some
values are spoiled on purpose, by rules on the data, so that the clean step has
work to do; ``ORACLE_RAW`` in ``oracles`` states the same rules in SQL.
"""

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace import schemas
from millrace.session import scratch_dir
from millrace.sinks.formats import write_drop

STAMP = datetime(2024, 1, 15, 12, 0, 0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _iso(ts: str) -> Column:
    """A zoneless timestamp as ISO text with Z."""
    return F.concat(
        F.replace(F.col(ts).cast("string"), F.lit(" "), F.lit("T")), F.lit("Z")
    )


def _money(column: str, kind: str) -> Column:
    """Through a decimal, which prints the same everywhere; a double does not."""
    return F.col(column).cast(kind).cast("string")


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nine text columns, one row per line item.

    The small tables join first, so line items shuffle once for their order and
    once for their part.  What a value depends on is decided on its own side and
    text is made after the last join, so that these rows are narrow.
    """
    buyers = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.expr("c_nationkey = n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.expr("n_regionkey = r_regionkey"))
        .select("c_custkey", F.when(F.col("c_acctbal") >= -900, F.col("r_name")).alias("region"))
    )
    pending = F.expr("o_orderstatus = 'P' and o_orderpriority = '4-NOT SPECIFIED'")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", F.coalesce(pending, F.lit(False)).alias("pending")
    )
    orders = orders.join(buyers, F.expr("o_custkey = c_custkey"))
    units = F.col("l_quantity").cast("int").cast("string")
    items = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        F.col("l_extendedprice").cast("decimal(14,2)").alias("total"),
        F.when(F.expr("l_discount > 0.095 and l_tax > 0.075"), "N/A")
        .when(F.col("l_linenumber") == 7, F.concat(units, F.lit(".7")))
        .otherwise(units)
        .alias("quantity"),
        F.coalesce(~F.expr("l_discount = 0 and l_tax = 0"), F.lit(False)).alias("named"),
    )
    lines = items.join(orders, F.expr("l_orderkey = o_orderkey")).select(
        "l_partkey",
        F.when(F.col("named"), F.col("o_orderkey")).alias("order_key"),
        "o_custkey", "total", "o_orderdate", "pending", "quantity", "region",
    )
    lines = lines.join(table(spark, sf_dir, "part"), F.expr("l_partkey = p_partkey"))

    columns = {
        "order_id": F.col("order_key").cast("string"),
        "product_name": F.col("p_name"),
        "category": F.col("p_type"),
        "quantity": F.col("quantity"),
        "unit_price": F.when(F.col("p_size") == 50, "N/A").otherwise(
            _money("p_retailprice", "decimal(12,2)")
        ),
        "total_price": F.col("total").cast("string"),
        "customer_id": F.col("o_custkey").cast("string"),
        "order_timestamp": F.when(F.col("pending"), "pending").otherwise(_iso("o_orderdate")),
        "region": F.col("region"),
    }
    return lines.select(*[columns[c].alias(c) for c in schemas.SALES_COLUMNS])


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as users: unique on ``user_id``."""
    customers = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.expr("c_nationkey = n_nationkey")
    )
    signup = F.date_add(F.lit("2020-01-01").cast("date"), F.col("c_nationkey"))
    columns = {
        "user_id": F.col("c_custkey").cast("string"),
        "first_name": F.substring_index("c_name", "#", 1),
        "last_name": F.substring_index("c_name", "#", -1),
        "email": F.concat(
            F.replace(F.lower("c_name"), F.lit("#"), F.lit(".")), F.lit("@example.com")
        ),
        "country": F.col("n_name"),
        "signup_date": signup.cast("string"),
        "is_active": F.col("c_acctbal") > 0,
    }
    return customers.select(*[columns[c].alias(c) for c in schemas.USER_COLUMNS])


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as payments."""
    columns = {
        "txn_id": F.col("o_orderkey").cast("string"),
        "user_id": F.col("o_custkey").cast("string"),
        "amount": F.col("o_totalprice"),
        "currency": F.lit("USD"),
        "status": F.when(F.col("o_orderstatus") == "F", "completed")
        .when(F.col("o_orderstatus") == "O", "pending")
        .otherwise("failed"),
        "txn_date": F.col("o_orderdate").cast("date").cast("string"),
        "merchant": F.col("o_orderpriority"),
    }
    return table(spark, sf_dir, "orders").select(
        *[columns[c].alias(c) for c in schemas.TRANSACTION_COLUMNS]
    )


def _operation() -> Column:
    return (
        F.when(F.col("event_type") == "signup", "INSERT")
        .when(F.col("event_type") == "error", "DELETE")
        .otherwise("UPDATE")
    )


def raw_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as change records in CSV text; the user is the order that changes."""
    columns = {
        "order_id": F.col("user_id").cast("string"),
        "product_name": F.col("event_type"),
        "category": F.col("props"),
        "quantity": F.lit("1"),
        "unit_price": _money("value", "decimal(14,2)"),
        "total_price": _money("value", "decimal(14,2)"),
        "customer_id": F.col("event_id").cast("string"),
        "order_timestamp": _iso("ts"),
        "region": F.lit(None).cast("string"),
        "operation": _operation(),
        "updated_at": _iso("ts"),
    }
    return table(spark, sf_dir, "events").select(
        *[columns[c].alias(c) for c in schemas.CHANGE_COLUMNS]
    )


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as typed changes: key, order, and two attributes."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("order_id"),
        _operation().alias("operation"),
        _iso("ts").try_cast("timestamp").alias("updated_at"),
        F.col("event_id").alias("change_id"),
        "value",
        "props",
    )


class Landing:
    """Landing folders with these tables, written once per application."""

    _written: dict[tuple, str] = {}

    @classmethod
    def _once(cls, spark, sf_dir, name, write) -> str:
        key = (spark.sparkContext.applicationId, sf_dir, name)
        if key not in cls._written:
            cls._written[key] = write(scratch_dir(spark, name))
        return cls._written[key]

    @classmethod
    def sales(cls, spark: SparkSession, sf_dir: str) -> str:
        return cls._once(
            spark,
            sf_dir,
            "landing-sales",
            lambda to: write_drop(raw_sales(spark, sf_dir), "sales", to, STAMP),
        )

    @classmethod
    def users(cls, spark: SparkSession, sf_dir: str) -> str:
        return cls._once(
            spark,
            sf_dir,
            "landing-users",
            lambda to: write_drop(users(spark, sf_dir), "users", to, STAMP),
        )

    @classmethod
    def clean(cls, spark: SparkSession, sf_dir: str) -> str:
        """Output of the sales job, for queries that start from it."""
        from millrace.plans.simple_etl import run_simple_etl

        def write(to):
            run_simple_etl(spark, cls.sales(spark, sf_dir), to, metrics=False)
            return to

        return cls._once(spark, sf_dir, "clean-sales", write)
