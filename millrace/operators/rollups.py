"""Totals that are kept as mergeable partial results, and sketches of what cannot be added up.

Sales are summed once per day, region and category when they come.  Those rows are stored by
month and batch; a batch recomputes the totals of the months that it touches from them, never
from the sales.  Totals over all days are made when they are read, from one row a day.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.sinks.partitioned import BATCH, clear_marker, drop_batch, read_committed, write_partitioned
from millrace.sources.files import list_files

LEVELS = ("order_date", "region", "category")
MONTH = "month"
# The month of sales without a date.
NO_MONTH = "none"

HLL_BITS = 14


def month_of(date: str) -> Column:
    return F.coalesce(F.date_format(date, "yyyy-MM"), F.lit(NO_MONTH))


def _sums(count: Column) -> list[Column]:
    return [
        count.alias("order_count"),
        F.sum("units").alias("units"),
        F.sum("revenue").cast("decimal(28,4)").alias("revenue"),
    ]


def sales_partials(sales: DataFrame) -> DataFrame:
    """One row for each day, region and category; nulls are groups of their own."""
    rows = sales.select(*LEVELS, F.col("quantity").cast("long").alias("units"), F.col("revenue").try_cast("decimal(18,4)").alias("revenue"))
    return rows.groupBy(*LEVELS).agg(*_sums(F.count(F.lit(1)))).withColumn(MONTH, month_of("order_date"))


def grouping_totals(partials: DataFrame, sets: Sequence[Sequence[str]] | None = None) -> DataFrame:
    """``partials`` summed by each of ``sets``; by default those of a rollup.

    ``grouping_id`` has a bit for each column of ``LEVELS``, the last one lowest: 1 if the row is a
    total over it, so that a null that stands for all is told from a null in the data.
    """
    if sets is None:
        sets = [LEVELS[:n] for n in range(len(LEVELS), -1, -1)]
    columns = [F.col(c) for c in LEVELS]
    grouped = partials.groupingSets([[F.col(c) for c in s] for s in sets], *columns)
    return grouped.agg(F.grouping_id().cast("long").alias("grouping_id"), *_sums(F.sum("order_count")))


def _months(spark: SparkSession, path: str, batch: str | None = None) -> set[str]:
    """Months that have files, of one batch or at all."""
    pattern = f"{path}/{MONTH}=*/" + (f"{BATCH}={batch}" if batch is not None else "")
    found = (s.getPath().toString() for s in list_files(spark, pattern.rstrip("/"), "*.parquet"))
    return {part.split("=", 1)[1] for name in found for part in name.split("/") if part.startswith(f"{MONTH}=")}


def add_sales(spark: SparkSession, sales: DataFrame, path: str, batch: str) -> None:
    """Put a batch of sales into the totals at ``path``; the same batch again replaces what it put there.

    ``batch`` is a word of letters, digits, ``-`` and ``_``.  Months that neither the batch nor an earlier
    try of it has rows for are left alone.
    """
    if not batch.replace("-", "").replace("_", "").isalnum():
        raise ValueError(f"batch={batch!r}: letters, digits, - and _ only")
    base = path.rstrip("/")
    stored, days = f"{base}/partials", f"{base}/days"
    touched = _months(spark, stored, batch)
    drop_batch(spark, stored, (MONTH, BATCH), batch)
    rows = sales_partials(sales).withColumn(BATCH, F.lit(batch))
    write_partitioned(rows, stored, by=(MONTH, BATCH), mode="append")
    touched |= _months(spark, stored, batch)
    if not touched:
        return
    partials = read_committed(spark, stored).filter(F.col(MONTH).isin(*sorted(touched)))  # folder names: few a year
    totals = grouping_totals(partials, [LEVELS[:n] for n in (3, 2, 1)])
    clear_marker(spark, days)
    for month in touched - _months(spark, stored):
        drop_batch(spark, days, (MONTH,), month)
    write_partitioned(totals.withColumn(MONTH, month_of("order_date")), days, by=(MONTH,), mode="overwrite")


def read_totals(spark: SparkSession, path: str) -> DataFrame:
    """All rows of the rollup over day, region and category, the grand total too."""
    days = read_committed(spark, f"{path.rstrip('/')}/days").drop(MONTH)
    return days.unionByName(grouping_totals(days.filter("grouping_id = 3"), [[]]))


def sketch_days(sales: DataFrame) -> DataFrame:
    """Sketches per day and region: ``buyers`` (HyperLogLog) and ``revenues`` (KLL quantiles).

    Null buyers, and revenues that are null or no finite number, are in no sketch.
    """
    usable = F.when(~F.isnan("revenue") & (F.abs("revenue") < float("inf")), F.col("revenue"))
    return sales.withColumn("revenue", usable).groupBy("order_date", "region").agg(
        F.hll_sketch_agg("customer_id", HLL_BITS).alias("buyers"), F.kll_sketch_agg_double("revenue").alias("revenues")
    )


def merge_sketches(days: DataFrame, *by: Column | str) -> DataFrame:
    """Sketches of ``sketch_days``, or of an earlier merge, merged by coarser groups; no sale is read again."""
    return days.groupBy(*by).agg(F.hll_union_agg("buyers").alias("buyers"), F.kll_merge_agg_double("revenues").alias("revenues"))


def sketch_estimates(sketches: DataFrame, quantile: float = 0.5) -> DataFrame:
    """The sketches as ``buyers``, a number, and ``revenue``, the quantile; null where nothing was sketched."""
    some = F.kll_sketch_get_n_double("revenues") > 0
    return sketches.withColumn("buyers", F.hll_sketch_estimate("buyers")).withColumn(
        "revenue", F.when(some, F.kll_sketch_get_quantile_double("revenues", F.lit(quantile)))
    ).drop("revenues")
