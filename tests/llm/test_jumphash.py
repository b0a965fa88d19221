"""Operator 3 against the generator in plain integers."""

import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from millrace.llm.jumphash import MULTIPLIER, jump_shard, shard_rows, write_shards


def jump(key, shards):
    at, to, key = -1, 0, (key or 0) % 2**64
    while to < shards:
        at = to
        key = (key * MULTIPLIER + 1) % 2**64
        to = int((at + 1) * (2.0**31 / ((key >> 33) + 1)))
    return at


@settings(max_examples=5, deadline=None)
@given(keys=st.lists(st.integers(-(2**63), 2**63 - 1), min_size=50, max_size=200), shards=st.sampled_from([1, 2, 8, 9, 100]))
def test_jump(spark, keys, shards):
    rows = spark.createDataFrame([(k,) for k in keys], "k long").select("k", jump_shard(F.col("k"), shards).alias("s")).collect()
    assert [(r.k, r.s) for r in rows] == [(k, jump(k, shards)) for k in keys]


@pytest.mark.parametrize("range_rows", [4096, 3])
@pytest.mark.parametrize("case", ["table", "awkward"])
def test_rows(cases, case, range_rows):
    docs, rows = cases[case]
    found = shard_rows(docs, 8, range_rows).collect()
    expected = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), jump(i, 8), jump(i, 9)) for i, t in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32, r.shard, r.grown_shard) for r in found) == expected
    slots = defaultdict(list)
    for r in found:
        slots[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 8)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_whole_rows_come_back(awkward):
    docs, _ = awkward
    found = shard_rows(docs)
    assert found.columns[: len(docs.columns)] == docs.columns
    assert sorted(map(repr, found.select(docs.columns).collect())) == sorted(map(repr, docs.collect()))


def test_rows_that_differ_in_other_columns_only(spark):
    rows = [(1, "a", ["x, y"], None), (1, "a", ["x", "y"], None), (1, "a", ["x", "y"], b"\xff"), (1, "a", ["x", "y"], b"\xfe"), (1, "a", None, None), (1, "a", None, None)]
    found = shard_rows(spark.createDataFrame(rows, "doc_id long, text string, tags array<string>, raw binary")).collect()
    assert Counter((r.doc_id, r.text, repr(r.tags), r.raw and bytes(r.raw)) for r in found) == Counter((a, b, repr(c), d) for a, b, c, d in rows)
    assert sorted(r.slot for r in found) == [*range(6)]


def test_written_by_shard(spark, awkward, tmp_path):
    docs, rows = awkward
    write_shards(docs, f"{tmp_path}/out")
    found = spark.read.parquet(f"{tmp_path}/out").collect()
    assert Counter((r.doc_id, r.text, r.shard) for r in found) == Counter((i, t, jump(i, 8)) for i, t in rows)


def test_empty(empty):
    assert shard_rows(empty).collect() == []


def test_no_python_in_the_plan(cases, plan):
    assert "Python" not in plan(shard_rows(cases["table"][0]))
