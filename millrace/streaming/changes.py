"""Apply new change files to a type-2 history, at a cost that follows the batch.

The change log is the source of truth, partitioned by a bucket of the key and by
batch.  The history has its closed versions and its open ones in folders of their
own, and beside it lies the time of each key's last change.  Changes that follow
what is known of their keys only need the open versions: a batch reads those of
the buckets it touches, appends the versions it closes, and leaves closed ones
alone.  Buckets in which a change is late are rebuilt from the log.
"""

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from millrace import schemas
from millrace.operators import cdc
from millrace.operators.metrics import observed
from millrace.operators.skew import DEFAULT_POLICY, SkewPolicy
from millrace.sinks.partitioned import clear_marker, set_marker, write_partitioned
from millrace.streaming.incremental import new_files

# Changes at one time are ordered by run, then file name, then place in the file.
TIE = ("run", "source_file", "source_start", "line")

LEVELS = ("key_bucket", "batch_id")


@dataclass(frozen=True)
class HistoryTables:
    """Where a history lives.  ``buckets`` is fixed when the tables are created:
    choose it so that one bucket of the log is worth rewriting as a unit."""

    log: str
    history: str
    rejects: str
    checkpoint: str
    key: str = "order_id"
    buckets: int = 256

    @property
    def state(self) -> str:
        """The last change of each key: its time and the batch it came with."""
        return f"{self.history.rstrip('/')}_state"

    def part(self, name: str) -> str:
        return f"{self.history.rstrip('/')}/part={name}"

    def bucket(self):
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")


def apply_new_changes(
    spark: SparkSession,
    source_path: str,
    tables: HistoryTables,
    max_files: int | None = None,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> None:
    """Read change files that arrived since the last run and update the history."""
    changes = new_files(
        spark, source_path, schemas.RAW_CHANGES, max_files
    ).select(
        "*",
        F.col("_metadata.file_name").alias("source_file"),
        F.col("_metadata.file_block_start").alias("source_start"),
    )
    stream = (
        changes.writeStream.foreachBatch(
            lambda batch, number: _apply_batch(batch, number, tables, policy)
        )
        .option("checkpointLocation", tables.checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    stream.awaitTermination()


def _apply_batch(
    batch: DataFrame, number: int, tables: HistoryTables, policy: SkewPolicy
) -> None:
    """Idempotent: a batch run again replaces what its first try wrote."""
    spark = batch.sparkSession
    checked = cdc.check_changes(
        batch.withColumns(
            {"run": F.lit(number).cast("long"), "line": F.monotonically_increasing_id()}
        ),
        tables.key,
    )
    bad, touched = Observation(), Observation()
    write_partitioned(
        cdc.usable(
            checked.observe(bad, F.count("reject_reason").alias("rows"))
        )
        .withColumns({"key_bucket": tables.bucket(), "batch_id": F.lit(number)})
        .observe(touched, F.collect_set("key_bucket").alias("buckets")),
        tables.log,
        by=LEVELS,
        mode="overwrite",
    )
    if observed(bad).get("rows") != 0:
        write_partitioned(
            cdc.rejected(checked).withColumn("batch_id", F.lit(number)),
            tables.rejects,
            by=("batch_id",),
            mode="overwrite",
        )
    buckets = observed(touched).get("buckets")
    if buckets:
        _advance(spark, tables, sorted(buckets), number, policy)


def _advance(
    spark: SparkSession,
    tables: HistoryTables,
    buckets: list[int],
    number: int,
    policy: SkewPolicy,
    rebuild: bool = False,
) -> None:
    """Bring the history of ``buckets`` up to batch ``number``.

    The history is written first, then the state, and old folders go last.  A crash
    before the state leaves the batch as new as it was.  One after it makes the
    changes look late, and the bucket is rebuilt from the log.  Until all is done
    the history has no commit marker.
    """
    key = tables.key
    changes = _read(spark, tables.log, _folders(spark, tables.log, buckets, at=number), schemas.CHANGE_LOG)
    state = _state(spark, tables, buckets, number)
    if rebuild:
        late = buckets
    else:
        behind = (F.col("updated_at") < F.col("last_time")) | (F.col("changed_in") >= number)
        found = changes.join(state, key).filter(behind).select(tables.bucket().alias("b"))
        late = sorted(r["b"] for r in found.distinct().collect())
    prompt = sorted(set(buckets) - set(late))

    results = []
    if late:
        log = _read(spark, tables.log, _folders(spark, tables.log, late), schemas.CHANGE_LOG)
        results.append(cdc.scd2_history(log, key, TIE, policy=policy))
    if prompt:
        folders = _folders(spark, tables.part("open"), prompt, below=number, newest=True)
        versions = _read(spark, tables.part("open"), folders, schemas.CHANGE_HISTORY)
        new = changes.filter(tables.bucket().isin(prompt)) if late else changes
        onward = cdc.as_changes(versions, new).unionByName(new)
        results.append(cdc.scd2_history(onward, key, TIE, policy=policy, probe=new))
    history = results[0] if len(results) == 1 else results[0].unionByName(results[1])

    clear_marker(spark, tables.history)
    write_partitioned(
        history.withColumns(
            {
                "part": F.when(F.col("is_current"), "open").otherwise("closed"),
                "key_bucket": tables.bucket(),
                "batch_id": F.lit(number),
            }
        ),
        tables.history,
        by=("part", *LEVELS),
        mode="overwrite",
        mark=False,
    )
    latest = changes if not rebuild else log
    last = latest.select(key, F.col("updated_at").alias("last_time"), F.lit(number).cast("long").alias("changed_in"))
    last = last.unionByName(state).groupBy(key).agg(F.max("last_time").alias("last_time"), F.max("changed_in").alias("changed_in"))
    write_partitioned(
        last.withColumns({"key_bucket": tables.bucket(), "batch_id": F.lit(number)}),
        tables.state,
        by=LEVELS,
        mode="overwrite",
    )
    _drop_others(spark, tables.state, buckets, number)
    _drop_others(spark, tables.part("open"), buckets, number)
    _drop_others(spark, tables.part("closed"), late, number)
    set_marker(spark, tables.history)


def _state(spark: SparkSession, tables: HistoryTables, buckets: list[int], number: int) -> DataFrame:
    folders = _folders(spark, tables.state, buckets, below=number + 1, newest=True)
    return _read(spark, tables.state, folders, f"`{tables.key}` string, last_time timestamp, changed_in long")


def rebuild_buckets(
    spark: SparkSession,
    tables: HistoryTables,
    buckets: Iterable[int],
    policy: SkewPolicy = DEFAULT_POLICY,
) -> None:
    """Rebuild the history of some buckets from the log."""
    present = {b: _batches(spark, tables.log, b) for b in buckets}
    newest = max((abs(n) for found in present.values() for n in found), default=None)
    if newest is not None:
        _advance(spark, tables, [b for b, found in present.items() if found], newest, policy, rebuild=True)


def compact_log(spark: SparkSession, tables: HistoryTables, batches: int = 16) -> list[int]:
    """Put the batches of each bucket that has more than ``batches`` into one; returns those buckets.

    The new folder is written before the old ones go.  A crash in between leaves
    changes twice, which a history takes as one.
    """
    crowded = {b: found for b in range(tables.buckets) if len(found := _batches(spark, tables.log, b)) > batches}
    if not crowded:
        return []
    number = -1 - max(abs(n) for found in crowded.values() for n in found)
    log = _read(spark, tables.log, _folders(spark, tables.log, crowded), schemas.CHANGE_LOG)
    write_partitioned(
        log.withColumns({"key_bucket": tables.bucket(), "batch_id": F.lit(number)}),
        tables.log,
        by=LEVELS,
        mode="overwrite",
    )
    _drop_others(spark, tables.log, crowded, number)
    return sorted(crowded)


def _read(spark: SparkSession, base: str, folders: list[str], schema) -> DataFrame:
    """The rows of some folders of a table; naming them keeps the others from being listed."""
    if not folders:
        return spark.createDataFrame([], schema)
    found = spark.read.schema(schema).option("basePath", base).parquet(*folders)
    return found.drop("part", *LEVELS)


def _path(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def _batches(spark: SparkSession, base: str, bucket: int) -> list[int]:
    files, place = _path(spark, f"{base}/key_bucket={bucket}")
    if not files.exists(place):
        return []
    names = [entry.getPath().getName() for entry in files.listStatus(place)]
    return sorted(int(n.partition("=")[2]) for n in names if n.startswith("batch_id="))


def _folders(
    spark: SparkSession,
    base: str,
    buckets: Iterable[int],
    at: int | None = None,
    below: int | None = None,
    newest: bool = False,
) -> list[str]:
    """Batch folders of some buckets: all, that of one batch, or the newest below one."""
    out = []
    for bucket in buckets:
        found = _batches(spark, base, bucket)
        if at is not None:
            found = [n for n in found if n == at]
        if below is not None:
            found = [n for n in found if n < below]
        if newest:
            found = found[-1:]
        out += [f"{base}/key_bucket={bucket}/batch_id={n}" for n in found]
    return out


def _drop_others(spark: SparkSession, base: str, buckets: Iterable[int], number: int) -> None:
    """Delete what a batch has replaced, also where it had nothing to write."""
    for folder in _folders(spark, base, buckets):
        if not folder.endswith(f"/batch_id={number}"):
            files, place = _path(spark, folder)
            files.delete(place, True)
