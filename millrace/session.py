"""Session defaults and the scratch folder."""

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a job of this library wants; spark-submit or the caller may override.
JOB_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app_name: str, master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    for key, value in {**JOB_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_FOLDERS: dict[tuple[str, str], str] = {}


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path for tables a run writes and reads back.

    The folder comes from ``spark.checkpoint.dir``, which on a cluster names
    storage every executor sees.  Only a local session may do without it.  All
    paths of an application lie in one folder, deleted when its driver ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        root = os.path.join(tempfile.gettempdir(), "millrace-checkpoints")
    owner = spark.sparkContext.applicationId, root
    if owner not in _FOLDERS:
        folder = f"{root.rstrip('/')}/millrace/{owner[0]}-{uuid.uuid4().hex[:8]}"
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        files.mkdirs(place)
        files.deleteOnExit(place)
        _FOLDERS[owner] = folder
    return f"{_FOLDERS[owner]}/{label}-{uuid.uuid4().hex}"
