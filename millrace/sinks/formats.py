"""Plain CSV, JSON and Parquet drops for the landing datasets."""

from datetime import datetime

from pyspark.sql import DataFrame

# File format of each dataset.
FORMATS = {
    "sales": "csv",
    "users": "json",
    "transactions": "parquet",
    "cdc": "csv",
}


def write_drop(df: DataFrame, dataset: str, folder: str, at: datetime) -> str:
    """Write ``df`` in its dataset's format under a time-stamped name.

    The drop is a folder of part files carrying the name the router looks for.  Text
    is compressed: a file is then read by one task, as it was written by one.
    """
    kind, _, _ = dataset.partition("_")
    extension = FORMATS[kind]
    path = f"{folder.rstrip('/')}/{dataset}_{at:%Y%m%d_%H%M%S}.{extension}"
    writer = df.write.mode("errorifexists")
    if extension == "csv":
        # Quote " like any CSV producer does, by doubling it.
        writer = writer.option("header", True).option("escape", '"')
    if extension != "parquet":
        writer = writer.option("compression", "gzip")
    writer.format(extension).save(path)
    return path
