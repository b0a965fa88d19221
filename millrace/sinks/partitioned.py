"""Hive-partitioned Parquet, its commit marker, and reading it back."""

from collections.abc import Sequence
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession, types as T

from millrace.operators.metrics import counted
from millrace.operators.skew import DEFAULT_POLICY, SkewPolicy, add_salt, heavy_keys

# Folder level that tells the runs that added to a table apart.
BATCH = "batch_id"

# Files a task of a local layout keeps open, so that it need not sort its rows by folder.
OPEN_FILES = 16
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def write_partitioned(
    df: DataFrame,
    path: str,
    by: Sequence[str] = ("region",),
    mode: str = "append",
    layout: str = "rebalance",
    policy: SkewPolicy = DEFAULT_POLICY,
    written: Observation | None = None,
    mark: bool = True,
) -> None:
    """Write one folder per value of ``by``.

    ``mode`` is ``append``, ``overwrite`` to replace only the folders that ``df``
    has rows for, which makes a re-run idempotent, or ``replace`` for the whole
    path.  ``written`` counts the rows in the writing stage.  Without ``mark`` an
    overwrite leaves the table unmarked, for a caller with more to do before that.

    ``layout="rebalance"`` shuffles by ``by`` and lets adaptive execution cut the
    result into files of the advisory size, so a value with a third of the rows
    becomes many tasks and a small one a single file.  Without adaptive execution
    values that are heavy under ``policy`` are salted instead.  ``layout="local"``
    does not shuffle: each task writes a file per value it holds, which suits few
    values and large input splits.  Up to ``OPEN_FILES`` values it does not sort either.
    """
    if mode not in ("append", "overwrite", "replace"):
        raise ValueError(f"unknown mode {mode!r}")
    rows = _arrange(df, by, layout, policy)
    if written is not None:
        rows = counted(rows, written)
    writer = rows.write.partitionBy(*by)
    with _open_files(df.sparkSession, OPEN_FILES if layout == "local" else 0):
        if mode == "overwrite":
            # A dynamic overwrite leaves no marker of its own.
            clear_marker(df.sparkSession, path)
            writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(
                path
            )
            if mark:
                set_marker(df.sparkSession, path)
        elif mode == "replace":
            writer.mode("overwrite").option("partitionOverwriteMode", "static").parquet(
                path
            )
        else:
            writer.mode("append").parquet(path)


@contextmanager
def _open_files(spark: SparkSession, files: int):
    """Let writing tasks keep ``files`` files open meanwhile; a caller's own setting stays."""
    before = spark.conf.get(_WRITERS, "0")
    if files and before == "0":
        spark.conf.set(_WRITERS, str(files))
    try:
        yield
    finally:
        if files and before == "0":
            spark.conf.unset(_WRITERS)


def _arrange(
    df: DataFrame, by: Sequence[str], layout: str, policy: SkewPolicy
) -> DataFrame:
    if layout == "local":
        return df
    if layout != "rebalance":
        raise ValueError(f"layout must be rebalance or local, not {layout!r}")
    if df.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true":
        return df.hint("rebalance", *by)
    heavy = heavy_keys(df, by[0], policy)
    if not heavy:
        return df.repartition(*by)
    salt = "_salt"
    while salt in df.columns:
        salt = f"_{salt}"
    salted = add_salt(df, by[0], heavy, salt)
    return salted.repartition(*by, salt).drop(salt)


def _marker(spark: SparkSession, path: str):
    """Commit marker of a table, and the file system it is on."""
    jvm = spark.sparkContext._jvm
    marker = jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + "/_SUCCESS")
    return marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), marker


def set_marker(spark: SparkSession, path: str) -> None:
    files, marker = _marker(spark, path)
    files.create(marker, True).close()


def clear_marker(spark: SparkSession, path: str) -> None:
    files, marker = _marker(spark, path)
    files.delete(marker, False)


def drop_batch(spark: SparkSession, path: str, by: Sequence[str], batch: str) -> None:
    """Remove the rows of ``batch``, the last level of ``by``; the table is unmarked until its next write."""
    files, marker = _marker(spark, path)
    levels = "/".join([*[f"{c}=*" for c in by[:-1]], f"{by[-1]}=*"])
    for found in files.globStatus(marker.getParent().suffix(f"/{levels}")) or []:
        if unquote(found.getPath().getName()) == f"{by[-1]}={batch}":
            clear_marker(spark, path)
            files.delete(found.getPath(), True)


def is_committed(spark: SparkSession, path: str) -> bool:
    """Whether a write to ``path`` finished.

    After an append this says that some run finished, not which; the metrics a
    job returns are the signal for a single run.
    """
    files, marker = _marker(spark, path)
    return files.exists(marker)


def read_committed(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    """Read Parquet written by a finished job; filters on folders prune files.

    With a ``schema`` only its columns come back: folders may have more levels, as
    those of ``ingest_new_files`` do.
    """
    if not is_committed(spark, path):
        raise FileNotFoundError(f"no finished write at {path}")
    if schema is None:
        return spark.read.parquet(path)
    found = spark.read.schema(schema).parquet(path)
    return found if found.columns == schema.names else found.select(_in_order(found, schema))


def _in_order(df: DataFrame, schema: T.StructType) -> list[str]:
    """The columns of ``schema`` as ``df`` has them: partition columns come last."""
    names = set(schema.names)
    return [f"`{c}`" for c in df.columns if c in names]
