"""Gapless numbers in a global order, without bringing the rows to one task."""

from pyspark.sql import DataFrame, Window, functions as F

from millrace.llm.components import stored


def numbered(df: DataFrame, *by: str, weight: str | None = None) -> DataFrame:
    """``df`` with ``place``, a row's number from 0 in the order of ``by``; with ``weight``, the sum of it over the rows before.

    The table is cut by range and written; each cut has numbered its own rows, and the cuts' sizes,
    one row for each cut, give the number where it begins.
    """
    cut = df.repartitionByRange(*by).sortWithinPartitions(*by)
    within = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    cut = stored(cut.withColumn("_cut", F.spark_partition_id()).withColumn("_within", within), "numbered")
    if weight:
        along = Window.partitionBy("_cut").orderBy("_within").rowsBetween(Window.unboundedPreceding, -1)
        cut = cut.withColumn("_within", F.coalesce(F.sum(weight).over(along), F.lit(0)))
    sizes = cut.groupBy("_cut").agg((F.sum(weight) if weight else F.max("_within") + 1).alias("n"))
    before = Window.orderBy("_cut").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select("_cut", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_first"))
    placed = cut.join(F.broadcast(firsts), "_cut")
    return placed.withColumn("place", F.col("_first") + F.col("_within")).drop("_cut", "_within", "_first")
