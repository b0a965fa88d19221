"""Change logs against a plain replay of the same rules."""

import datetime
import random
from itertools import groupby

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from millrace.operators import cdc, skew
from millrace.operators.skew import SkewPolicy

T0 = datetime.datetime(2024, 1, 1)
SCHEMA = "order_id string, operation string, updated_at timestamp, change_id long, v string"

# Treats a key with more than a few changes as heavy.
EAGER = SkewPolicy(min_bytes=0, min_hits=5, cell_rows=5)


def log_of(spark, changes):
    """Changes are (key, operation, minute, value); their order breaks ties."""
    data = [
        (k, op, None if m is None else T0 + datetime.timedelta(minutes=m), i, v)
        for i, (k, op, m, v) in enumerate(changes)
    ]
    return spark.createDataFrame(data, SCHEMA)


def replay(changes, collapse=False):
    """Versions as (key, value, from, to), by walking the log."""
    out = []
    timed = [c for c in enumerate(changes) if c[1][2] is not None]
    ordered = sorted(timed, key=lambda c: (c[1][0] or "", c[1][2], c[0]))
    for key, group in groupby(ordered, key=lambda c: c[1][0]):
        last = {}
        for _, (_, op, minute, value) in group:
            last[minute] = (op, value)
        versions = []
        for minute, (op, value) in sorted(last.items()):
            open_version = versions and versions[-1][3] is None
            if collapse and op != "DELETE" and open_version and versions[-1][1] == value:
                continue
            if open_version:
                versions[-1][3] = minute
            if op != "DELETE":
                versions.append([key, value, minute, None])
        out += [tuple(v) for v in versions]
    return sorted(out, key=repr)


def minutes(ts):
    return None if ts is None else int((ts - T0).total_seconds() // 60)


def versions(df):
    found = df.collect()
    assert all(r["is_current"] == (r["valid_to"] is None) for r in found)
    return sorted(
        (
            (r["order_id"], r["v"], minutes(r["valid_from"]), minutes(r["valid_to"]))
            for r in found
        ),
        key=repr,
    )


CASES = {
    "insert only": [("a", "INSERT", 1, "x")],
    "insert and updates": [("a", "INSERT", 1, "x"), ("a", "UPDATE", 2, "y"), ("a", "UPDATE", 5, "z")],
    "insert and delete": [("a", "INSERT", 1, "x"), ("a", "DELETE", 2, "x")],
    "reinsert": [("a", "INSERT", 1, "x"), ("a", "DELETE", 2, "x"), ("a", "INSERT", 3, "x")],
    "update of an unknown key": [("a", "UPDATE", 1, "x")],
    "delete of an unknown key": [("a", "DELETE", 1, "x")],
    "one time, insert last": [("a", "DELETE", 1, "x"), ("a", "INSERT", 1, "y")],
    "one time, delete last": [("a", "INSERT", 1, "x"), ("a", "DELETE", 1, "y")],
    "late change": [("a", "INSERT", 1, "x"), ("a", "UPDATE", 9, "z"), ("a", "UPDATE", 5, "y")],
    "null value": [("a", "INSERT", 1, None), ("a", "UPDATE", 2, None), ("b", "INSERT", 1, "x")],
    "repeated value": [("a", "INSERT", 1, "x"), ("a", "UPDATE", 2, "x"), ("a", "UPDATE", 3, "y"), ("a", "UPDATE", 3, "x")],
}


@pytest.mark.parametrize("collapse", [False, True])
@pytest.mark.parametrize("name", CASES)
def test_history_cases(spark, name, collapse):
    df = cdc.scd2_history(log_of(spark, CASES[name]), collapse_unchanged=collapse)
    assert versions(df) == replay(CASES[name], collapse)


def test_reinsert_leaves_a_gap(spark):
    assert versions(cdc.scd2_history(log_of(spark, CASES["reinsert"]))) == [
        ("a", "x", 1, 2),
        ("a", "x", 3, None),
    ]


CHANGE = st.tuples(
    st.sampled_from(["a", "a", "b", None]),
    st.sampled_from(["INSERT", "UPDATE", "UPDATE", "DELETE"]),
    st.one_of(st.integers(0, 40), st.integers(0, 40), st.none()),
    st.sampled_from(["x", "y", None]),
)


@settings(
    max_examples=12,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(changes=st.lists(CHANGE, max_size=80), cut=st.integers(0, 80))
def test_any_log(spark, changes, cut):
    log = log_of(spark, changes)
    history = cdc.scd2_history(log)
    expected = replay(changes)
    assert versions(history) == expected

    assert versions(cdc.scd2_history(log, policy=EAGER)) == expected

    timed = log.filter("updated_at is not null")
    state = sorted((str(r["order_id"]), str(r["v"])) for r in cdc.current_state(timed).collect())
    assert state == sorted((str(k), str(v)) for k, v, _, to in expected if to is None)

    before = cdc.scd2_history(log.filter(F.col("change_id") < cut))
    batch = log.filter(F.col("change_id") >= cut)
    assert versions(cdc.scd2_incremental(before, log, batch)) == expected


def skewed_changes(seed, n=400, hot_key="hot"):
    """A third of the changes on one key, a pile of them at one instant, some without a time."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        hot = rng.random() < 0.4
        key = hot_key if hot else f"k{rng.randrange(60)}"
        minute = 77 if hot and rng.random() < 0.3 else rng.randrange(150)
        if rng.random() < 0.1:
            minute = None
        op = rng.choice(["INSERT", "UPDATE", "UPDATE", "DELETE"])
        out.append((key, op, minute, rng.choice(["x", "y"])))
    return out


@pytest.mark.parametrize("collapse", [False, True])
@pytest.mark.parametrize("seed, hot_key", [(1, "hot"), (2, "hot"), (3, None), (4, None)])
def test_sliced_history_is_the_same(spark, seed, hot_key, collapse):
    changes = skewed_changes(seed, hot_key=hot_key)
    log = log_of(spark, changes).repartition(3)
    slices = skew.heavy_slices(log, "order_id", "updated_at", EAGER)
    assert slices.cuts.count() >= 1
    assert slices.instants.filter(F.col("_heavy_key").eqNullSafe(F.lit(hot_key))).count() >= 1
    assert slices.null_key == (hot_key is None)
    df = cdc.scd2_history(log, collapse_unchanged=collapse, policy=EAGER)
    assert versions(df) == replay(changes, collapse)
    assert versions(cdc.scd2_history(log, collapse_unchanged=collapse)) == replay(changes, collapse)


def test_slice_edges_are_not_hinted(spark):
    log = log_of(spark, skewed_changes(5))
    text = cdc.scd2_history(log, collapse_unchanged=True, policy=EAGER)._jdf.queryExecution().analyzed().toString()
    lines = text.splitlines()
    hinted = [lines[i + 1] for i, line in enumerate(lines) if "ResolvedHint" in line]
    assert hinted and "_edge" in text
    assert not any("_edge" in line for line in hinted)


def test_slices_bound_the_groups(spark):
    """Ordered like the changes, and none much larger than a cell."""
    log = log_of(spark, [("hot", "UPDATE", m, "x") for m in range(1000)])
    cuts = skew.heavy_slices(log, "order_id", "updated_at", EAGER).cuts
    sliced = skew.add_slice(log, "order_id", "updated_at", cuts)
    groups = sliced.groupBy("_slice").agg(
        F.count("*").alias("n"), F.min("updated_at").alias("a"), F.max("updated_at").alias("b")
    ).orderBy("_slice").collect()
    assert max(g["n"] for g in groups) <= 5
    assert min(g["_slice"] for g in groups) > 0
    assert all(x["b"] < y["a"] for x, y in zip(groups, groups[1:]))


def test_incremental_with_heavy_keys(spark):
    changes = skewed_changes(9)
    log = log_of(spark, changes)
    late = F.col("change_id") % 3 == 0
    before = cdc.scd2_history(log.filter(~late))
    after = cdc.scd2_incremental(before, log, log.filter(late), policy=EAGER)
    assert versions(after) == replay(changes)


def test_rejected_changes(spark):
    data = [
        ("a", "INSERT", "2024-01-01T00:00:00Z"),
        ("a", "UPSERT", "2024-01-01T00:00:00Z"),
        ("a", "insert", "2024-01-01T00:00:00Z"),
        ("a", None, "2024-01-01T00:00:00Z"),
        (None, "INSERT", "2024-01-01T00:00:00Z"),
        ("a", "INSERT", "soon"),
        ("a", "INSERT", None),
    ]
    raw = spark.createDataFrame(data, "order_id string, operation string, updated_at string")
    checked = cdc.check_changes(raw)
    assert cdc.usable(checked).count() == 1
    reasons = [r["reject_reason"] for r in cdc.rejected(checked).collect()]
    assert sorted(reasons) == ["missing key"] + ["unknown operation"] * 3 + [
        "unreadable updated_at"
    ] * 2


def test_offsets_are_ordered_as_instants(spark):
    data = [
        ("a", "INSERT", "2024-01-01T10:00:00+02:00", 1, "x"),
        ("a", "UPDATE", "2024-01-01T09:00:00Z", 0, "y"),
    ]
    raw = spark.createDataFrame(
        data, "order_id string, operation string, updated_at string, change_id long, v string"
    )
    assert cdc.current_state(cdc.usable(cdc.check_changes(raw))).first()["v"] == "y"


def test_plans(spark, plan):
    log = log_of(spark, CASES["late change"])
    assert plan(cdc.scd2_history(log)).count("Exchange\n") <= 1
    state = plan(cdc.current_state(log))
    assert "partial_max_by" in state
    assert "Window" not in state
