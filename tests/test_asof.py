"""As-of join against a loop over plain rows."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from millrace.operators.asof import asof_join
from millrace.operators.skew import SkewPolicy

# Treats any key, and any instant, with more than a handful of rows as heavy.
EAGER = SkewPolicy(min_bytes=0, min_hits=20, cell_rows=20)
START = datetime(2024, 1, 1)
LEFT = "k string, t timestamp, n int"
RIGHT = "k string, at timestamp, seq int, v string, m map<string,int>"


def some_rows(seed, size, instants=400):
    rng = random.Random(seed)
    when = lambda: None if rng.random() < 0.05 else START + timedelta(minutes=rng.randrange(instants))
    who = lambda: rng.choice(["hot", "hot", "a", "b", None])
    left = [(who(), when(), i) for i in range(size)]
    right = [(who(), when(), rng.randrange(3), rng.choice(["x", "y", None]), {"a": i % 2}) for i in range(size)]
    return left, right


def brute_force(left, right, strict=False, within=None, inner=False):
    out = []
    for k, t, n in left:
        best = None
        for rk, at, seq, v, m in right:
            if None in (k, t, rk, at) or rk != k or at > t or (strict and at == t):
                continue
            place = (at, seq, v is not None, v or "", m["a"])
            if best is None or place > best[0]:
                best = (place, (at, seq, v, m))
        if best and within and best[1][0] + within < t:
            best = None
        if best or not inner:
            out.append((k, t, n, *(best[1] if best else (None,) * 4)))
    return sorted(out, key=repr)


def frames(spark, left, right):
    return spark.createDataFrame(left, LEFT).repartition(3), spark.createDataFrame(right, RIGHT).repartition(3)


def joined(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("policy", [SkewPolicy(), EAGER])
@pytest.mark.parametrize("instants", [400, 5])
@pytest.mark.parametrize("strict,within,how", [(False, None, "left"), (True, None, "inner"), (False, 20, "left")])
def test_matches_brute_force(spark, policy, instants, strict, within, how):
    left, right = some_rows(instants, 300, instants)
    a, b = frames(spark, left, right)
    limit = None if within is None else F.expr(f"interval {within} minutes")
    found = asof_join(a, b, "k", "t", "at", ("seq",), strict, limit, how, policy=policy)
    gap = None if within is None else timedelta(minutes=within)
    assert joined(found) == brute_force(left, right, strict, gap, how == "inner")


def test_hot_key_is_cut_and_spread(spark):
    """No task gets the rows of the key that nine tenths of the table have."""
    rows = spark.range(0, 40_000, numPartitions=8).select(
        F.when(F.col("id") % 10 > 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.timestamp_micros(F.col("id") * 1_000_000).alias("t"),
        "id",
    )
    right = rows.filter("id % 50 = 1").select("k", F.col("t").alias("at"), F.col("id").alias("r"))
    policy = SkewPolicy(min_bytes=0, min_hits=20, cell_rows=1000)
    other = spark.newSession()
    other.conf.set("spark.sql.shuffle.partitions", "32")
    other.conf.set("spark.sql.adaptive.enabled", "false")
    found = asof_join(rows, right, "k", "t", "at", policy=policy)
    wrong = found.filter("k = 'hot' and id > 0 and not (r <=> (id - 1) div 50 * 50 + 1)")
    assert wrong.count() == 0
    from millrace.operators import skew

    slices = skew.heavy_slices(rows, "k", "t", policy)
    parts = skew.add_slice(rows, "k", "t", slices.cuts).groupBy("_slice").count().filter("_slice > 0")
    assert parts.count() > 20
    assert parts.agg(F.max("count")).first()[0] < 4000


def test_several_key_columns(spark):
    left = spark.createDataFrame([(1, "a", START, 1), (1, "b", START, 2), (1, None, START, 3)], "x int, y string, t timestamp, n int")
    right = spark.createDataFrame([(1, "a", START, 7), (1, None, START, 8)], "x int, y string, at timestamp, v int")
    found = asof_join(left, right, ["x", "y"], "t", "at")
    assert sorted((r.n, r.v) for r in found.collect()) == [(1, 7), (2, None), (3, None)]


def test_clashing_names_and_empty_sides(spark):
    left, right = some_rows(1, 30)
    a, b = frames(spark, left, right)
    with pytest.raises(ValueError, match="both sides"):
        asof_join(a, b.withColumnRenamed("v", "N"), "k", "t", "at")
    with pytest.raises(ValueError, match="left or inner"):
        asof_join(a, b, "k", "t", "at", how="right")
    found = asof_join(a, b.withColumnRenamed("v", "n"), "k", "t", "at", ("seq",), prefix="r_")
    assert found.columns == ["k", "t", "n", "r_at", "r_seq", "r_n", "r_m"]
    assert joined(found) == brute_force(left, right)
    assert joined(asof_join(a, b.limit(0), "k", "t", "at")) == brute_force(left, [])
    assert asof_join(a.limit(0), b, "k", "t", "at").collect() == []


def test_one_shuffle(spark, plan):
    left, right = some_rows(2, 30)
    a, b = (df.coalesce(2) for df in frames(spark, left, right))
    text = plan(asof_join(a, b, "k", "t", "at", how="inner"))
    tree = text.split("\n\n\n")[0]
    assert tree.count("hashpartitioning") + text.count("Arguments: hashpartitioning") == 1
    assert "Join" not in tree
