"""Synthetic datasets, one row per id of the table they are given.

Pass ``spark.range(n)`` for n rows, or any table with a long column ``id``.
"""

from pyspark.sql import Column, DataFrame, functions as F

from millrace import schemas
from millrace.functions.synth import draw, instant_text, pick, uuid_text

# Regions of the sales data.
REGIONS = ("us-east", "us-west", "eu-west", "ap-southeast", "ca-central")

PRODUCTS = (
    ("Trail Lantern", "Sports"),
    ("Oat Clusters", "Food"),
    ("Desk Speaker", "Electronics"),
    ("Yoga Block", "Sports"),
    ("Olive Tapenade", "Food"),
    ("Travel Router", "Electronics"),
    ("Climbing Chalk", "Sports"),
    ("Rye Crackers", "Food"),
    ("Pocket Scanner", "Electronics"),
)
FIRST_NAMES = ("Ada", "Bela", "Chidi", "Dara", "Emre", "Freya", "Goran", "Hana")
LAST_NAMES = ("Abara", "Brandt", "Castell", "Dufour", "Eriksen", "Fontana", "Grewal")
COUNTRIES = ("Brazil", "Canada", "France", "Ghana", "India", "Japan", "Norway")
CURRENCIES = ("USD", "EUR", "GBP")
MERCHANTS = ("Birch and Daughters", "Corner Goods", "Harbour Supply", "Tallow Ltd")

DAY = 24 * 60 * 60

# Rates are kept to twelve decimals.
RATE_STEPS = 10**12


def _sales_columns(seed: int, id_column: str, order_key: Column, users: int) -> dict:
    quantity = draw(seed, "quantity", id_column, 20) + 1
    cents = draw(seed, "unit_price", id_column, 49_901) + 100
    product = draw(seed, "product", id_column, len(PRODUCTS)).cast("int")

    def of_product(part: int) -> Column:
        return F.get(F.array(*[F.lit(p[part]) for p in PRODUCTS]), product)

    return {
        "order_id": uuid_text(seed, "order", order_key),
        "product_name": of_product(0),
        "category": of_product(1),
        "quantity": quantity.cast("int"),
        "unit_price": cents / F.lit(100.0),
        "total_price": (quantity * cents) / F.lit(100.0),
        "customer_id": uuid_text(seed, "user", draw(seed, "buyer", id_column, users)),
        "order_timestamp": instant_text(
            "2024-01-01", draw(seed, "ordered", id_column, 366 * DAY)
        ),
        "region": pick(seed, "region", id_column, REGIONS),
    }


def _select(df: DataFrame, columns: dict, names) -> DataFrame:
    return df.select(*[columns[n].alias(n) for n in names])


def sales(
    ids: DataFrame, seed: int = 1, users: int = 1000, null_rate: float = 0.0
) -> DataFrame:
    """Orders with 1-20 units at 1.00-500.00; ``null_rate`` of the ids missing."""
    columns = _sales_columns(seed, "id", F.col("id"), users)
    if null_rate:
        missing = draw(seed, "missing", "id", RATE_STEPS) < round(null_rate * RATE_STEPS)
        columns["order_id"] = F.when(~missing, columns["order_id"])
    return _select(ids, columns, schemas.SALES_COLUMNS)


def users(ids: DataFrame, seed: int = 1) -> DataFrame:
    """Accounts, 80 % of them active.  Ids 0..n-1 are the buyers of ``sales``."""
    first = pick(seed, "first_name", "id", FIRST_NAMES)
    last = pick(seed, "last_name", "id", LAST_NAMES)
    signup = F.date_add(
        F.lit("2020-01-01").cast("date"),
        draw(seed, "signup", "id", 4 * 365).cast("int"),
    )
    columns = {
        "user_id": uuid_text(seed, "user", "id"),
        "first_name": first,
        "last_name": last,
        "email": F.concat(
            F.lower(F.concat_ws(".", first, last)), F.lit("@example.com")
        ),
        "country": pick(seed, "country", "id", COUNTRIES),
        "signup_date": signup.cast("string"),
        "is_active": draw(seed, "active", "id", 10) < 8,
    }
    return _select(ids, columns, schemas.USER_COLUMNS)


def transactions(ids: DataFrame, seed: int = 1, users: int = 1000) -> DataFrame:
    """Payments of 5.00-2000.00; 70 % completed, 20 % pending, 10 % failed."""
    tenth = draw(seed, "status", "id", 10)
    day = F.date_add(
        F.lit("2024-01-01").cast("date"), draw(seed, "day", "id", 366).cast("int")
    )
    columns = {
        "txn_id": uuid_text(seed, "transaction", "id"),
        "user_id": uuid_text(seed, "user", draw(seed, "payer", "id", users)),
        "amount": (draw(seed, "amount", "id", 199_501) + 500) / F.lit(100.0),
        "currency": pick(seed, "currency", "id", CURRENCIES),
        "status": F.when(tenth < 7, "completed")
        .when(tenth < 9, "pending")
        .otherwise("failed"),
        "txn_date": day.cast("string"),
        "merchant": pick(seed, "merchant", "id", MERCHANTS),
    }
    return _select(ids, columns, schemas.TRANSACTION_COLUMNS)


def changes(
    ids: DataFrame,
    mode: str,
    seed: int = 1,
    users: int = 1000,
    base_rows: int | None = None,
) -> DataFrame:
    """A change log over ``sales``.

    ``full`` inserts each id once.  ``incremental`` is 20 % inserts of new orders,
    60 % updates and 20 % deletes of the ``base_rows`` orders already there.
    """
    if mode == "full":
        columns = _sales_columns(seed, "id", F.col("id"), users)
        columns["operation"] = F.lit("INSERT")
        columns["updated_at"] = columns["order_timestamp"]
    elif mode == "incremental":
        if not base_rows:
            raise ValueError("incremental changes need base_rows")
        tenth = draw(seed, "operation", "id", 10)
        order_key = F.when(tenth < 2, F.col("id") + F.lit(base_rows)).otherwise(
            draw(seed, "changed", "id", base_rows)
        )
        columns = _sales_columns(seed + 1, "id", order_key, users)
        columns["order_id"] = uuid_text(seed, "order", order_key)
        columns["customer_id"] = uuid_text(
            seed, "user", draw(seed + 1, "buyer", "id", users)
        )
        columns["operation"] = (
            F.when(tenth < 2, "INSERT").when(tenth < 8, "UPDATE").otherwise("DELETE")
        )
        columns["updated_at"] = instant_text(
            "2025-01-01", draw(seed, "updated", "id", 30 * DAY)
        )
    else:
        raise ValueError(f"mode must be full or incremental, not {mode!r}")
    return _select(ids, columns, schemas.CHANGE_COLUMNS)
