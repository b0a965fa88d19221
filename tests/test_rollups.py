"""Kept totals against plain grouping, and sketches against exact numbers."""

import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from millrace.operators import rollups

SCHEMA = "order_id int, customer_id string, order_date date, region string, category string, quantity int, revenue double"


def sales(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def some_rows(low, high):
    days = [None, date(2024, 1, 31), date(2024, 2, 1), date(2024, 2, 2), date(2024, 3, 5)]
    return [(i, f"u{i % 17}", days[i % 5], [None, "EU", "US"][i % 3], ["a", None][i % 2], i % 4 or None, float(i) / 4 if i % 7 else float("nan")) for i in range(low, high)]


def totals(df, rows):
    return rows(df.select("order_date", "region", "category", "grouping_id", "order_count", "units", F.col("revenue").cast("double")))


def expected(df, rows):
    return totals(rollups.grouping_totals(rollups.sales_partials(df)), rows)


def by_hand(plain):
    out = {}
    for n in range(4):
        for r in plain:
            key = (*(r[2:5][:n]), *[None] * (3 - n), (1 << (3 - n)) - 1)
            count, units, revenue = out.get(key, (0, None, None))
            units = units if r[5] is None else (units or 0) + r[5]
            revenue = revenue if r[6] != r[6] else (revenue or 0) + r[6]
            out[key] = (count + 1, units, revenue)
    return sorted(((*k, *v) for k, v in out.items()), key=repr)


def test_totals(spark, rows):
    plain = some_rows(0, 100)
    assert expected(sales(spark, plain), rows) == by_hand(plain)


def test_batches_in_any_order_and_again(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    parts = [some_rows(0, 40), some_rows(40, 60), some_rows(60, 100)]
    rollups.add_sales(spark, sales(spark, parts[2]), path, "c")
    rollups.add_sales(spark, sales(spark, parts[0]), path, "a")
    rollups.add_sales(spark, sales(spark, parts[0] + parts[1]), path, "b")
    assert totals(rollups.read_totals(spark, path), rows) == by_hand(sum(parts, []) + parts[0])
    rollups.add_sales(spark, sales(spark, parts[1]), path, "b")
    assert totals(rollups.read_totals(spark, path), rows) == by_hand(sum(parts, []))


def test_only_touched_months_are_written(spark, tmp_path):
    path = str(tmp_path / "t")
    rollups.add_sales(spark, sales(spark, some_rows(0, 50)), path, "a")
    stamps = lambda: {d: max(os.path.getmtime(f"{path}/days/{d}/{f}") for f in os.listdir(f"{path}/days/{d}")) for d in os.listdir(f"{path}/days") if "=" in d}
    before = stamps()
    assert set(before) == {"month=2024-01", "month=2024-02", "month=2024-03", "month=none"}
    rollups.add_sales(spark, sales(spark, [r for r in some_rows(50, 80) if r[2] and r[2].month == 2]), path, "b")
    after = stamps()
    assert {d for d in after if after[d] != before[d]} == {"month=2024-02"}


def test_a_month_that_a_batch_gives_up(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    plain = some_rows(0, 50)
    january = [r for r in plain if r[2] == date(2024, 1, 31)]
    rest = [r for r in plain if r[2] != date(2024, 1, 31)]
    rollups.add_sales(spark, sales(spark, rest), path, "a")
    rollups.add_sales(spark, sales(spark, january), path, "b")
    rollups.add_sales(spark, sales(spark, rest[:1]), path, "b")
    assert totals(rollups.read_totals(spark, path), rows) == by_hand(rest + rest[:1])
    rollups.add_sales(spark, sales(spark, []), path, "b")
    assert totals(rollups.read_totals(spark, path), rows) == by_hand(rest)


def test_batch_names(spark, tmp_path):
    with pytest.raises(ValueError, match="letters"):
        rollups.add_sales(spark, sales(spark, []), str(tmp_path), "a/b")


def test_hot_group_is_summed_before_the_shuffle(spark, plan):
    text = plan(rollups.sales_partials(sales(spark, some_rows(0, 10))))
    assert text.count("HashAggregate") >= 2 and text.index("partial_sum") > 0


def test_sketches_merge_without_loss(spark):
    """Half of the sales are one buyer's; errors are those of one sketch over all."""
    rows = spark.range(0, 60_000, numPartitions=6).select(
        F.when(F.col("id") % 2 == 0, "hot").otherwise((F.col("id") * 7919 % 9001).cast("string")).alias("customer_id"),
        F.date_add(F.lit(date(2024, 1, 1)), (F.col("id") % 60).cast("int")).alias("order_date"),
        F.lit("EU").alias("region"),
        F.when(F.col("id") % 10 > 0, F.col("id").cast("double")).when(F.col("id") % 20 == 0, float("nan")).alias("revenue"),
    )
    month = rollups.month_of("order_date").alias("month")
    days = rollups.sketch_days(rows)
    found = {r.month: r for r in rollups.sketch_estimates(rollups.merge_sketches(days, month)).collect()}
    exact = rows.groupBy(month).agg(F.count_distinct("customer_id").alias("n"), F.expr("percentile(nanvl(revenue, null), 0.5)").alias("m"))
    for r in exact.collect():
        assert abs(found[r.month].buyers - r.n) <= 0.03 * r.n
        assert abs(found[r.month].revenue - r.m) <= 0.03 * 60_000
    everything = rollups.merge_sketches(rollups.merge_sketches(days, month), F.lit(1).alias("one"))
    (row,) = rollups.sketch_estimates(everything).collect()
    assert abs(row.buyers - 9002) <= 0.03 * 9002


def test_sketches_of_nothing(spark):
    rows = sales(spark, [(1, None, date(2024, 1, 1), "EU", "a", 1, None)])
    (row,) = rollups.sketch_estimates(rollups.sketch_days(rows)).collect()
    assert (row.buyers, row.revenue) == (0, None)
