"""Totals by event time from files that arrive late, out of order and twice.

Each micro-batch is split by the watermark that the batches before it have left: rows that
are older go to a side table, the others are freed of copies that this batch or those
since the watermark brought, kept, and summed by window.  All of it lies in tables by
batch, so a batch that is tried again replaces what its first try wrote, and what is read
for duplicates are the days since the watermark, not the history.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from millrace.functions import casts
from millrace.sinks.partitioned import BATCH, is_committed, write_partitioned
from millrace.streaming.incremental import new_files

# Raw event files: text columns.
RAW_EVENTS = T.StructType([T.StructField(c, T.StringType()) for c in ("event_id", "user_id", "event_type", "ts", "value")])
_EVENT = "event_id string, user_id string, event_type string, ts timestamp, value decimal(18,2)"
ACCEPTED = f"{_EVENT}, day string, {BATCH} long"
LATE = f"{_EVENT}, reason string, {BATCH} long"
TOTALS = f"window_start timestamp, event_type string, events long, value decimal(28,2), {BATCH} long"
MARKS = f"high timestamp, {BATCH} long"


@dataclass(frozen=True)
class EventTables:
    """Folders of a stream: ``accepted`` rows, ``late`` rows, ``totals`` and ``marks`` below ``path``."""

    path: str
    delay: str = "1 hour"
    window: str = "1 hour"

    def __getattr__(self, name: str) -> str:
        if name.startswith("_"):
            raise AttributeError(name)
        return f"{self.path.rstrip('/')}/{name}"


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table, or no rows before its first write has ended."""
    return spark.read.schema(schema).parquet(path) if is_committed(spark, path) else spark.createDataFrame([], schema)


def watermark(spark: SparkSession, tables: EventTables, before: int | None = None):
    """The time before which rows are late: the latest one seen, less the delay; None at first."""
    marks = _read(spark, tables.marks, MARKS)
    if before is not None:
        marks = marks.filter(F.col(BATCH) < before)
    return marks.agg((F.max("high") - F.expr(f"interval {tables.delay}")).alias("mark")).first()["mark"]


def _typed(raw: DataFrame) -> DataFrame:
    return raw.select(
        "event_id", "user_id", "event_type", casts.to_instant("ts").alias("ts"), F.col("value").try_cast("decimal(18,2)").alias("value")
    )


def _one_each(events: DataFrame) -> DataFrame:
    """One row for each ``event_id``: the earliest, of equal ones the first by its columns."""
    place = F.struct("ts", "user_id", "event_type", "value")
    return events.groupBy("event_id").agg(F.min(place).alias("row")).select(
        "event_id", "row.user_id", "row.event_type", "row.ts", "row.value"
    )


def window_totals(events: DataFrame, window: str) -> DataFrame:
    """Number and value of events by window and type; mergeable by sums."""
    start: Column = F.window("ts", window)["start"].alias("window_start")
    return events.groupBy(start, "event_type").agg(F.count("*").alias("events"), F.sum("value").cast("decimal(28,2)").alias("value"))


def add_batch(batch: DataFrame, number: int, tables: EventTables) -> None:
    """Put one micro-batch into the tables; the same number again replaces it."""
    spark = batch.sparkSession
    mark = watermark(spark, tables, number)
    rows = _typed(batch)
    usable = F.col("event_id").isNotNull() & F.col("ts").isNotNull()
    late = F.lit(False) if mark is None else F.coalesce(F.col("ts") < F.lit(mark), F.lit(False))
    by_batch = lambda df: df.withColumn(BATCH, F.lit(number).cast("long"))
    reason = F.when(~usable, "unusable").when(late, "late")
    aside = by_batch(rows.withColumn("reason", reason).filter("reason is not null"))
    write_partitioned(aside, tables.late, by=(BATCH,), mode="overwrite")

    since = _read(spark, tables.accepted, ACCEPTED).filter(F.col(BATCH) < number)
    if mark is not None:
        # rows of the watermark's own day may be older; they do no harm
        since = since.filter(F.col("day") >= F.date_format(F.lit(mark), "yyyy-MM-dd"))
    new = _one_each(rows.filter(usable & ~late)).join(since.select("event_id"), "event_id", "left_anti")
    kept = by_batch(new.withColumn("day", F.date_format("ts", "yyyy-MM-dd")))
    write_partitioned(kept, tables.accepted, by=("day", BATCH), mode="overwrite")
    own = _read(spark, tables.accepted, ACCEPTED).filter(F.col(BATCH) == number)
    write_partitioned(by_batch(window_totals(own, tables.window)), tables.totals, by=(BATCH,), mode="overwrite")
    # the mark ends the batch: those after it see all of it
    write_partitioned(by_batch(rows.agg(F.max("ts").alias("high"))), tables.marks, by=(BATCH,), mode="overwrite")


def ingest_events(spark: SparkSession, source_path: str, tables: EventTables, max_files: int | None = None) -> None:
    """Read the event files that arrived since the last run."""
    stream = (
        new_files(spark, source_path, RAW_EVENTS, max_files)
        .writeStream.foreachBatch(lambda batch, number: add_batch(batch, number, tables))
        .option("checkpointLocation", tables.checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    stream.awaitTermination()


def event_totals(spark: SparkSession, tables: EventTables, with_late: bool = False) -> DataFrame:
    """Totals by window and type.  ``with_late`` adds late rows that no accepted one is a copy of.

    If copies of an event have one time, that is what a query over all files gives, however they came.
    """
    totals = _read(spark, tables.totals, TOTALS).drop(BATCH)
    if with_late:
        late = _one_each(_read(spark, tables.late, LATE).filter("reason = 'late'"))
        accepted = _read(spark, tables.accepted, ACCEPTED).select("event_id")
        totals = totals.unionByName(window_totals(late.join(accepted, "event_id", "left_anti"), tables.window))
    return totals.groupBy("window_start", "event_type").agg(
        F.sum("events").alias("events"), F.sum("value").cast("decimal(28,2)").alias("value")
    )
