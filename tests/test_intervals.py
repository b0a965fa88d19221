"""Interval joins against a loop over plain rows."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from millrace.operators.intervals import FAN, interval_join, version_at
from millrace.operators.skew import SkewPolicy

START = datetime(1969, 12, 1)
POINTS = "k string, t timestamp, n int"
SPANS = "k string, a timestamp, b timestamp, v int"


def some_rows(seed, size=150):
    rng = random.Random(seed)
    when = lambda: None if rng.random() < 0.06 else START + timedelta(minutes=rng.randrange(100_000))
    who = lambda: rng.choice(["hot", "hot", "a", None])
    points = [(who(), when(), i) for i in range(size)]
    spans = []
    for i in range(size):
        a = when()
        long = rng.choice([-5, 0, 1, 59, 60, 61, 600, 20_000, 10**7, 2 * 10**8])
        spans.append((who(), a, None if rng.random() < 0.2 or a is None else a + timedelta(minutes=long), i))
    # bounds that meet
    spans.append(("a", points[0][1] or START, None, -1))
    points.append(("a", spans[-1][1], -1))
    points += [(k, b, -2) for k, _, b, _ in spans[:20]]
    return points, spans


def brute_force(points, spans, left=False, keyed=True):
    out = []
    for k, t, n in points:
        hits = [
            (k, t, n, *([] if keyed else [sk]), a, b, v) for sk, a, b, v in spans
            if not (t is None or a is None) and (not keyed or (k == sk and k is not None)) and a <= t and (b is None or t < b)
        ]
        out += hits if hits or not left else [(k, t, n, None, None, None)]
    return sorted(out, key=repr)


def joined(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("finest", [3_600_000_000, 1_000_000, 60_000_000_000_000])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_matches_brute_force(spark, finest, how):
    points, spans = some_rows(3)
    a, b = spark.createDataFrame(points, POINTS), spark.createDataFrame(spans, SPANS)
    found = interval_join(a, b, "k", "t", "a", "b", how, finest=finest)
    assert joined(found) == brute_force(points, spans, how == "left")


def test_without_a_key(spark):
    points, spans = some_rows(4, 60)
    a, b = spark.createDataFrame(points, POINTS), spark.createDataFrame(spans, SPANS)
    found = interval_join(a, b.withColumnRenamed("k", "owner"), [], "t", "a", "b")
    assert joined(found) == brute_force(points, spans, keyed=False)


def test_an_interval_is_in_two_bins_at_most(spark, plan):
    points, spans = some_rows(5)
    b = spark.createDataFrame(spans, SPANS)
    found = interval_join(spark.createDataFrame(points, POINTS), b, "k", "t", "a", "b")
    text = plan(found)
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    assert FAN == 16
    days = spark.range(20_000).select(F.lit("hot").alias("k"), F.timestamp_micros(F.col("id") * 86_400_000_000).alias("t"), "id")
    long = days.filter("id % 1000 = 0").select("k", F.col("t").alias("a"), (F.col("t") + F.expr("interval 5000 days")).alias("b"))
    assert interval_join(days, long, "k", "t", "a", "b").count() == sum(min(5000, 20_000 - i) for i in range(0, 20_000, 1000))


def test_versions(spark):
    """A history's versions do not overlap, so both ways find the same."""
    rng = random.Random(6)
    points, _ = some_rows(6)
    spans = []
    for k in ["hot", "a", "c"]:
        cuts = sorted(rng.sample(range(100_000), 40))
        for x, y in zip(cuts, cuts[1:] + [None]):
            if rng.random() < 0.8:  # deleted in between
                spans.append((k, START + timedelta(minutes=x), None if y is None else START + timedelta(minutes=y), x))
    a = spark.createDataFrame(points, POINTS)
    b = spark.createDataFrame(spans, SPANS).withColumnsRenamed({"a": "valid_from", "b": "valid_to"})
    for policy in (SkewPolicy(), SkewPolicy(min_bytes=0, min_hits=20, cell_rows=20)):
        assert joined(version_at(a, b, "k", "t", policy=policy)) == brute_force(points, spans, left=True)


def test_clash_and_empty(spark):
    points, spans = some_rows(7, 20)
    a, b = spark.createDataFrame(points, POINTS), spark.createDataFrame(spans, SPANS)
    with pytest.raises(ValueError, match="both sides"):
        interval_join(a, b.withColumnRenamed("v", "n"), "k", "t", "a", "b")
    with pytest.raises(ValueError, match="inner or left"):
        interval_join(a, b, "k", "t", "a", "b", "full")
    assert interval_join(a, b.withColumnRenamed("v", "n"), "k", "t", "a", "b", prefix="s_").columns == ["k", "t", "n", "s_a", "s_b", "s_n"]
    assert joined(interval_join(a, b.limit(0), "k", "t", "a", "b", "left")) == brute_force(points, [], True)
    assert interval_join(a.limit(0), b, "k", "t", "a", "b", "left").collect() == []
