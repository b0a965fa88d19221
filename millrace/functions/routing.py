"""Which dataset a landing file belongs to, by its name."""

from pyspark.sql import Column, functions as F

# File name pattern and landing prefix, first match wins.
ROUTES = (
    ("sales_*.csv", "sales/"),
    ("users_*.json", "users/"),
    ("transactions_*.parquet", "transactions/"),
    ("cdc_*.csv", "cdc/"),
)


def landing_prefix(name) -> Column:
    """Prefix for a file name, null for a file no pattern matches.

    Each pattern has one ``*``, which may match nothing, and is case-sensitive;
    so a start and an end test say it all, without a regex.
    """
    name = F.col(name) if isinstance(name, str) else name
    choices = []
    for pattern, prefix in ROUTES:
        start, end = pattern.split("*")
        matches = name.startswith(start) & name.endswith(end)
        choices.append(F.when(matches, F.lit(prefix)))
    return F.coalesce(*choices)
