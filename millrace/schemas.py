"""Schemas of the four landing datasets.

Sales and change-log files are CSV, so every raw column is text and all typing
happens in the clean step.  Users arrive as JSON, transactions as Parquet.
"""

from pyspark.sql import types as T

# Dataset column names, in file order.
SALES_COLUMNS = (
    "order_id",
    "product_name",
    "category",
    "quantity",
    "unit_price",
    "total_price",
    "customer_id",
    "order_timestamp",
    "region",
)
USER_COLUMNS = (
    "user_id",
    "first_name",
    "last_name",
    "email",
    "country",
    "signup_date",
    "is_active",
)
TRANSACTION_COLUMNS = (
    "txn_id",
    "user_id",
    "amount",
    "currency",
    "status",
    "txn_date",
    "merchant",
)
CHANGE_COLUMNS = SALES_COLUMNS + ("operation", "updated_at")
CHANGE_OPERATIONS = ("INSERT", "UPDATE", "DELETE")


def text_schema(columns) -> T.StructType:
    """All-string, all-nullable schema: what a CSV file with a header carries."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def _typed(columns, **overrides) -> T.StructType:
    return T.StructType(
        [T.StructField(c, overrides.get(c, T.StringType())) for c in columns]
    )


RAW_SALES = text_schema(SALES_COLUMNS)
RAW_CHANGES = text_schema(CHANGE_COLUMNS)
USERS = _typed(USER_COLUMNS, is_active=T.BooleanType())
TRANSACTIONS = _typed(TRANSACTION_COLUMNS, amount=T.DoubleType())

# Output of the clean step.  Read partitioned output with this schema, never by
# inference: an all-numeric region would otherwise come back as an integer.
CLEAN_SALES = T.StructType(
    list(
        _typed(
            SALES_COLUMNS, quantity=T.IntegerType(), unit_price=T.DoubleType()
        ).fields
    )
    + [
        T.StructField("order_date", T.DateType()),
        T.StructField("revenue", T.DoubleType()),
    ]
)
ENRICHED_SALES = T.StructType(CLEAN_SALES.fields + USERS.fields[1:])
DAILY_REGION = T.StructType(
    [
        T.StructField("order_date", T.DateType()),
        T.StructField("region", T.StringType()),
        T.StructField("order_count", T.LongType()),
        T.StructField("units", T.LongType()),
        T.StructField("revenue", T.DecimalType(28, 4)),
    ]
)

# The change log of ``apply_new_changes`` and the history it keeps.
CHANGE_LOG = T.StructType(
    [f for f in RAW_CHANGES if f.name != "updated_at"]
    + [
        T.StructField("updated_at", T.TimestampType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("source_start", T.LongType()),
        T.StructField("run", T.LongType()),
        T.StructField("line", T.LongType()),
    ]
)
CHANGE_HISTORY = T.StructType(
    RAW_SALES.fields
    + [
        T.StructField("valid_from", T.TimestampType()),
        T.StructField("valid_to", T.TimestampType()),
        T.StructField("is_current", T.BooleanType()),
    ]
)
