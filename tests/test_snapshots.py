"""Snapshot differences against plain multisets, and applied again."""

import random
from collections import Counter, defaultdict
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from millrace.operators.cdc import current_state
from millrace.operators.snapshots import snapshot_changes

SCHEMA = "k string, part string, n int, v double, extra map<string,int>"


def some_rows(seed, size=200):
    rng = random.Random(seed)
    row = lambda i: (rng.choice([None, f"k{i}", f"k{i}", f"k{i % 7}"]), rng.choice(["x", "y", None]), rng.choice([None, 0, 1]), rng.choice([None, 0.0, 1.5]), {"a": i % 3})
    before = [row(i) for i in range(size)]
    after = [r for r in before if rng.random() < 0.9]
    after = [(r[0], r[1], 7, *r[3:]) if rng.random() < 0.1 else r for r in after] + [row(1000 + i) for i in range(20)]
    return before, after + after[:5]


def brute_force(before, after):
    sides = [defaultdict(Counter), defaultdict(Counter)]
    for rows, side in zip((before, after), sides, strict=True):
        for r in rows:
            side[r[0]][repr(r)] += 1
    out = []
    for k in {*sides[0], *sides[1]}:
        old, new = sides[0][k], sides[1][k]
        if old != new:
            kind = "INSERT" if not old else "DELETE" if not new else "UPDATE"
            out.append((k, kind, sum(old.values()), sum(new.values())))
    return sorted(out, key=repr)


@pytest.mark.parametrize("partition", [(), "part", ["part", "n"]])
def test_matches_brute_force(spark, partition):
    before, after = some_rows(1)
    a, b = spark.createDataFrame(before, SCHEMA).repartition(3), spark.createDataFrame(after, SCHEMA).repartition(4)
    found = snapshot_changes(a, b, "k", partition)
    assert found.columns == [*a.columns, "operation", "n_before", "n_after"]
    rows = found.collect()
    assert sorted(((r.k, r.operation, r.n_before, r.n_after) for r in rows), key=repr) == brute_force(before, after)
    for r in rows:
        side = before if r.operation == "DELETE" else after
        assert tuple(r)[:5] in side


def test_equal_states_give_nothing(spark):
    before, _ = some_rows(2)
    a = spark.createDataFrame(before, SCHEMA)
    assert snapshot_changes(a, a.repartition(7).select(*reversed(a.columns)), "k", "part").collect() == []
    assert snapshot_changes(a.limit(0), a.limit(0), "k").collect() == []
    kinds = {r.operation for r in snapshot_changes(a.limit(0), a, "k").collect()}
    assert kinds == {"INSERT"}


def test_ignored_columns_and_other_columns(spark):
    a = spark.createDataFrame([("x", 1, 5)], "k string, n int, seen int")
    b = spark.createDataFrame([("x", 1, 6)], "k string, n int, seen int")
    assert snapshot_changes(a, b, "k", ignore=["seen"]).collect() == []
    assert [r.operation for r in snapshot_changes(a, b, "k").collect()] == ["UPDATE"]
    with pytest.raises(ValueError, match="columns differ"):
        snapshot_changes(a, b.drop("seen"), "k")


def test_nulls_do_not_move_between_columns(spark):
    a = spark.createDataFrame([("x", 1, None)], "k string, a int, b int")
    b = spark.createDataFrame([("x", None, 1)], "k string, a int, b int")
    assert [r.operation for r in snapshot_changes(a, b, "k").collect()] == ["UPDATE"]


def test_the_log_rebuilds_the_state(spark):
    """Change logs of successive states lead to the last one."""
    stamp = lambda day: F.lit(datetime(2024, 1, day))
    states = [[], [("a", 1), ("b", 2)], [("a", 3), ("b", 2), ("c", 4)], [("b", 2), ("c", 5)]]
    frames = [spark.createDataFrame(s, "k string, v int") for s in states]
    logs = [snapshot_changes(a, b, "k", at=stamp(i + 1)) for i, (a, b) in enumerate(zip(frames, frames[1:]))]
    log = logs[0].unionByName(logs[1]).unionByName(logs[2]).drop("n_before", "n_after")
    found = current_state(log, "k", tie=())
    assert sorted((r.k, r.v) for r in found.collect()) == states[-1]


def test_hot_key_sends_one_row_a_task(spark):
    """Half of the rows are copies with one key: counted before the shuffle."""
    rows = spark.range(0, 40_000, numPartitions=8).select(F.when(F.col("id") % 2 == 0, -1).otherwise(F.col("id")).alias("k"), F.lit(1).alias("v"))
    found = snapshot_changes(rows, rows.unionAll(rows.filter("k = -1").limit(1)), "k")
    assert [tuple(r) for r in found.collect()] == [(-1, 1, "UPDATE", 20_000, 20_001)]
