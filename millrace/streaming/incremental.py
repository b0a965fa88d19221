"""Process the files that arrived since the last run, then stop.

The checkpoint remembers each file by name and gives every file to exactly one
micro-batch, however old its time stamp is.  A file rewritten under its old name
is not seen again.
"""

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from millrace import schemas
from millrace.operators.clean import clean_sales
from millrace.sinks.partitioned import BATCH, write_partitioned
from millrace.sources.files import FILES, list_files

# The stream source forgets files older than this, counted back from the newest
# one it has seen, and skips them if they arrive later.  No file is that old.
MAX_FILE_AGE = "36500d"


def new_files(
    spark: SparkSession,
    source_path: str,
    schema: T.StructType = schemas.RAW_SALES,
    max_files: int | None = None,
    source_format: str = "csv",
    archive_path: str | None = None,
) -> DataFrame:
    """Stream of CSV or JSON files; ``max_files`` bounds a micro-batch after an outage.

    ``source_path`` is what the batch readers take: a file, a drop, a glob, or a folder of
    drops, of which files with the name of the format count, at any depth.  A path without
    any file is a ``FileNotFoundError``, unless files are archived and so may be gone.  Files already processed are moved below ``archive_path`` if it is given; this
    keeps the listing and the source folder short.
    """
    if source_format not in ("csv", "json"):
        raise ValueError(f"source_format must be csv or json, not {source_format!r}")
    reader = spark.readStream.schema(schema).option("maxFileAge", MAX_FILE_AGE).option("recursiveFileLookup", True)
    names = "*"
    if _is_folder(spark, source_path):
        names = FILES[source_format]
        reader = reader.option("pathGlobFilter", names)
    if not archive_path and next(list_files(spark, source_path, names), None) is None:
        raise FileNotFoundError(f"no files to read under {source_path}")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if archive_path:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_path)
    if source_format == "json":
        return reader.json(source_path)
    return (
        reader.option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .csv(source_path)
    )


def ingest_new_files(
    spark: SparkSession,
    source_path: str,
    output_path: str,
    checkpoint_path: str,
    transform: Callable[[DataFrame], DataFrame] = clean_sales,
    by: Sequence[str] = ("region",),
    max_files: int | None = None,
    source_format: str = "csv",
    archive_path: str | None = None,
) -> None:
    """Clean the new sales files and add them to partitioned Parquet.

    A micro-batch has its own ``batch_id`` folder below each value of ``by``, named
    after the checkpoint and its number.  Trying it again replaces what the first
    try wrote, and the commit marker is there only while no write is under way.
    The target may hold rows of other runs in that layout, such as those of
    ``run_simple_etl`` with a ``batch``; a target without that level is refused,
    since readers cannot mix the two.
    """
    _check_layout(spark, output_path, by)
    run = _checkpoint_name(spark, checkpoint_path)

    def add(batch: DataFrame, number: int) -> None:
        rows = transform(batch).withColumn(BATCH, F.lit(f"{run}-{number}"))
        write_partitioned(rows, output_path, by=(*by, BATCH), mode="overwrite", layout="local")

    stream = (
        new_files(spark, source_path, schemas.RAW_SALES, max_files, source_format, archive_path)
        .writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )
    stream.awaitTermination()


def _file_system(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def _is_folder(spark: SparkSession, path: str) -> bool:
    files, place = _file_system(spark, path)
    # a name with a star in it is no file of that name
    return files.exists(place) and files.getFileStatus(place).isDirectory()


def _check_layout(spark: SparkSession, output_path: str, by: Sequence[str]) -> None:
    """Refuse a target whose folders of ``by`` hold anything but ``batch_id`` folders."""
    base = output_path.rstrip("/")
    files, pattern = _file_system(spark, "/".join([base, *[f"{column}=*" for column in by], "*"]))
    for found in files.globStatus(pattern) or []:
        name = found.getPath().getName()
        if not name.startswith(("_", ".", f"{BATCH}=")):
            raise ValueError(f"{output_path} has no {BATCH} folders: {found.getPath()}")
    files, pattern = _file_system(spark, f"{base}/*.parquet")
    if len(files.globStatus(pattern) or []):
        raise ValueError(f"{output_path} is not partitioned by {', '.join(by)}")


def _checkpoint_name(spark: SparkSession, checkpoint_path: str) -> str:
    """A name that stays with a checkpoint, so that a new one never replaces old batches."""
    files, place = _file_system(spark, f"{checkpoint_path.rstrip('/')}/_ingest")
    found = files.globStatus(place.suffix("/*")) or []
    if len(found):
        return found[0].getPath().getName()
    name = uuid.uuid4().hex[:12]
    files.mkdirs(place.suffix(f"/{name}"))
    return name
