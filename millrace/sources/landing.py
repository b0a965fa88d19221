"""The landing folder: what lies there and where it should go."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.functions.routing import landing_prefix


def list_landing(spark: SparkSession, folder: str) -> DataFrame:
    """``(file_name, parts, length)`` of the entries at the top of ``folder``.

    An entry is a file, or a drop written by Spark: a folder of part files under
    one name.  Contents are never read, as the content column is pruned.  Spark's
    scans leave empty files out; those at the top come from the file system's own
    listing of that one folder.  A missing folder lists as empty.
    """
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    system = path.getFileSystem(conf)
    root = system.makeQualified(path).toString()
    top = system.listStatus(path) if system.exists(path) else []
    empty = [
        (entry.getPath().getName(), 1, 0)
        for entry in top
        if entry.isFile() and entry.getLen() == 0 and not entry.getPath().getName().startswith(("_", "."))
    ]
    try:
        files = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", True)
            .load(root)
        )
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        files = spark.createDataFrame([], "path string, length long")
    inside = F.substr("path", F.lit(len(root) + 2))
    listed = (
        files.select(F.substring_index(inside, "/", 1).alias("file_name"), "length")
        .groupBy("file_name")
        .agg(F.count(F.lit(1)).alias("parts"), F.sum("length").alias("length"))
    )
    return listed.union(
        spark.createDataFrame(empty, "file_name string, parts long, length long")
    )


def manifest(listing: DataFrame, target: str) -> DataFrame:
    """Entries that have a dataset, with their target, sorted by name."""
    base = F.lit(target.rstrip("/") + "/")
    return (
        listing.withColumn("prefix", landing_prefix("file_name"))
        .filter("prefix is not null")
        .withColumn("target", F.concat(base, "prefix", "file_name"))
        .orderBy("file_name")
    )
