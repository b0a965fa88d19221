"""Catalog registration, for SQL over the written tables."""

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, types as T


def register_table(
    spark: SparkSession,
    name: str,
    path: str,
    schema: T.StructType,
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """An external Parquet table over ``path``, with all folders that are there now.

    A table of that name is refreshed if it is external and lies at ``path``, so
    calling this again after an append picks up new folders.  Any other table of
    that name is left alone, and the call fails.
    """
    if spark.catalog.tableExists(name):
        found = {
            row["col_name"]: row["data_type"]
            for row in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
        }
        at = found.get("Location", "")
        if found.get("Type") != "EXTERNAL" or _qualified(spark, at) != _qualified(spark, path):
            raise ValueError(f"{name} exists and is not an external table at {path}: {found.get('Type')} {at}")
    else:
        columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in schema)
        names = ", ".join(map(_quoted, partition_by))
        clause = f"PARTITIONED BY ({names})" if partition_by else ""
        text = path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet {clause} LOCATION '{text}'"
        )
    spark.catalog.refreshTable(name)
    if partition_by:
        spark.catalog.recoverPartitions(name)
    return spark.table(name)


def query(spark: SparkSession, text: str, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Run SQL with ``tables`` visible as temporary views, for this one query.

    They have names of their own and are bound by a WITH clause, so no view of the
    caller's is replaced; the plan is resolved before they go.
    """
    own = {name: f"_{name}_{uuid.uuid4().hex}" for name in tables}
    try:
        for name, df in tables.items():
            df.createOrReplaceTempView(own[name])
        views = ", ".join(f"{_quoted(name)} AS (SELECT * FROM {view})" for name, view in own.items())
        text = text.strip()
        if text[:5].upper() == "WITH ":
            text = text[5:]
            return spark.sql(f"WITH {views}, {text}" if views else f"WITH {text}")
        return spark.sql(f"WITH {views} {text}" if views else text)
    finally:
        for view in own.values():
            spark.catalog.dropTempView(view)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _qualified(spark: SparkSession, path: str) -> str:
    """A path with scheme and without a final slash, as the catalog lists it."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return found.getFileSystem(conf).makeQualified(found).toString()
