"""Readers for the landing datasets.  No reader infers types from data."""

import csv
from concurrent.futures import ThreadPoolExecutor
from fnmatch import fnmatch
from hashlib import md5
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from millrace import schemas

# File names of each format below a folder of drops, compressed or not.
FILES = {"csv": "*.csv*", "json": "*.json*", "parquet": "*.parquet"}


def read_csv(
    spark: SparkSession,
    path,
    schema: T.StructType = schemas.RAW_SALES,
    multiline: bool = False,
    glob: str | None = None,
    recursive: bool = True,
) -> DataFrame:
    """All CSV files under ``path``, in its folders too, headers checked against ``schema``.

    Raises ``FileNotFoundError`` if there is no file.

    Spark binds CSV columns by position.  A file with another header order would
    be read into the wrong columns, so this reader fails on it; ``read_drifted``
    accepts it.  ``multiline`` allows line breaks inside quotes but makes each
    file one task.
    """
    reader = (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("multiLine", multiline)
        .option("recursiveFileLookup", recursive)
    )
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return _found(reader.csv(path), path)


def _found(df: DataFrame, path) -> DataFrame:
    """``df``, a scan; raises if Spark has listed no file for it."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    if len(leaves.apply(0).relation().location().inputFiles()) == 0:
        raise FileNotFoundError(f"no files to read under {path}")
    return df


def read_sales_json(
    spark: SparkSession, path, glob: str | None = None, recursive: bool = True
) -> DataFrame:
    """Line-delimited JSON sales, every value as text like those from CSV."""
    reader = spark.read.schema(schemas.RAW_SALES).option("recursiveFileLookup", recursive)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return _found(reader.json(path), path)


def read_changes(spark: SparkSession, path, **options) -> DataFrame:
    return read_csv(spark, path, schemas.RAW_CHANGES, **options)


def read_users(spark: SparkSession, path) -> DataFrame:
    """Line-delimited JSON users: a file, a drop, or the ``.json`` files of a folder of drops."""
    reader = spark.read.schema(schemas.USERS).option("recursiveFileLookup", True)
    if not is_file(spark, path):
        reader = reader.option("pathGlobFilter", FILES["json"])
    return _found(reader.json(path), path)


def is_file(spark: SparkSession, path) -> bool:
    """Whether ``path`` names one file and neither a folder nor several paths."""
    if not isinstance(path, str):
        return False
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.exists(place) and files.getFileStatus(place).isFile()


def read_transactions(spark: SparkSession, path) -> DataFrame:
    """Parquet payments: a file, a drop, or the ``.parquet`` files of a folder of drops."""
    reader = spark.read.schema(schemas.TRANSACTIONS).option("recursiveFileLookup", True)
    if not is_file(spark, path):
        reader = reader.option("pathGlobFilter", FILES["parquet"])
    return _found(reader.parquet(path), path)


def list_files(spark: SparkSession, path: str, pattern: str = "*"):
    """Status of each file that ``path`` (a file, a folder or a glob) holds, in folders too, one after the other.

    Only names that match ``pattern`` count; hidden ones, which Spark skips, do not.
    """
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for top in files.globStatus(place) or []:
        base = top.getPath().toString().rstrip("/")
        found = files.listFiles(top.getPath(), True)
        while found.hasNext():
            status = found.next()
            # the folders below the one that was asked for, and the name
            names = status.getPath().toString()[len(base) :].strip("/").split("/")
            hidden = any(n.startswith((".", "_")) and "=" not in n for n in names if n)
            if not hidden and fnmatch(status.getPath().getName(), pattern):
                yield status


def listing_digest(spark: SparkSession, path: str, pattern: str = "*") -> str:
    """A text that changes if a file comes, goes or is written anew."""
    lines = sorted(f"{s.getPath()} {s.getLen()} {s.getModificationTime()}" for s in list_files(spark, path, pattern))
    return f"{len(lines)} files {md5(chr(10).join(lines).encode(), usedforsecurity=False).hexdigest()}"


def set_modified(spark: SparkSession, path: str, at: float) -> None:
    """Set the time stamp of the files of one drop, in seconds since 1970."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for found in files.listStatus(place):
        files.setTimes(found.getPath(), int(at * 1000), -1)


def inline_table(spark: SparkSession, rows, schema=schemas.RAW_SALES) -> DataFrame:
    """A small table from rows at hand, with an explicit schema."""
    return spark.createDataFrame(rows, schema)


HEADER_BYTES = 8 << 10
HEADER_READERS = 32


def _header_of(spark: SparkSession, uri: str) -> str | None:
    """The first line of a file that is not blank, from as many bytes as that takes."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri))
    stream = place.getFileSystem(conf).open(place)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(place)
    try:
        content = codec.createInputStream(stream) if codec else stream
        head = b""
        while True:
            more = bytes(content.readNBytes(HEADER_BYTES))
            head += more
            lines = head.replace(b"\r\n", b"\n").replace(b"\r", b"\n").split(b"\n")
            whole = lines if len(more) < HEADER_BYTES else lines[:-1]
            for line in whole:
                text = line.decode("utf-8", "replace").removeprefix("\ufeff")
                if text.strip(" \t"):
                    return text
            if len(more) < HEADER_BYTES:
                return None
    finally:
        stream.close()


def csv_headers(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """``(path, header)`` of each CSV file under ``path``: its first line that is not blank.

    Spark lists the files.  Some threads of the driver then read the first kilobytes
    of each, since no scan of Spark's stops inside a file.  Files without any line
    are left out.
    """
    reader = spark.read.option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    uris = _found(reader.text(path), path).inputFiles()
    with ThreadPoolExecutor(HEADER_READERS) as threads:
        headers = list(threads.map(lambda uri: _header_of(spark, uri), uris))
    rows = [(uri, header) for uri, header in zip(uris, headers, strict=True) if header is not None]
    return spark.createDataFrame(rows, "path string, header string")


def column_names(header: str) -> list[str]:
    """Column names of a header line, without outer blanks and in lower case."""
    return [name.strip().lower() for name in next(csv.reader([header]), [])]


def unrecognised(headers: DataFrame, required: str = "order_id") -> DataFrame:
    """The files among ``headers`` whose header does not have the column ``required``."""
    lines = [r["header"] for r in headers.select("header").distinct().collect()]
    foreign = [line for line in lines if required not in column_names(line)]
    return headers.filter(F.col("header").isin(foreign)) if foreign else headers.limit(0)


def read_drifted(
    spark: SparkSession,
    path: str,
    schema: T.StructType = schemas.RAW_SALES,
    headers: DataFrame | None = None,
    required: str = "order_id",
    set_aside: bool = False,
    glob: str | None = None,
) -> DataFrame:
    """CSV files whose headers differ in order, spelling or the columns they have.

    Names match without regard to case and outer blanks; cells lose outer blanks
    and are null if nothing is left.  Columns a file lacks are null, columns
    ``schema`` lacks are dropped.  A file without ``required`` is an error, or with
    ``set_aside`` left out; ``unrecognised`` lists such files.

    There is one scan for each distinct header, not for each file.  ``headers``
    takes a stored result of ``csv_headers``.  With several headers the paths go
    through the driver, which holds the list of files of any scan anyway.
    """
    if headers is None:
        headers = csv_headers(spark, path, glob)
    found = headers.groupBy("header").agg(F.collect_list("path").alias("paths")).collect()
    foreign = [r for r in found if required not in column_names(r["header"])]
    if foreign and not set_aside:
        examples = sorted(min(r["paths"]) for r in foreign)[:5]
        raise ValueError(f"files without a column {required!r}, such as {examples}")

    wanted = [f.name for f in schema.fields]
    table = spark.createDataFrame([], schema)
    for header, paths in found:
        names = column_names(header)
        if required not in names:
            continue
        places = [f"c{i}" for i in range(len(names))]
        files = path if len(found) == 1 else [unquote(p) for p in paths]
        # all of these files have this very header, so binding by position is right
        reader = spark.read.schema(schemas.text_schema(places)).option("header", True)
        reader = reader.option("escape", '"').option("recursiveFileLookup", True)
        if glob and len(found) == 1:
            reader = reader.option("pathGlobFilter", glob)
        rows = reader.csv(files)
        columns = []
        for name in wanted:
            cell = F.lit(None).cast("string")
            if name in names:
                cell = F.nullif(F.btrim(F.col(f"c{names.index(name)}")), F.lit(""))
            columns.append(cell.alias(name))
        table = table.unionByName(rows.select(*columns))
    return table
