"""Operator 11 against scores in Python integers."""

import random

import numpy as np
import pytest
from conftest_llm import SF, same
from pyspark.sql import functions as F

from millrace.llm.hardneg import COPIES, PRIMES, integers, mine_hard_negatives, op11_hard_negatives, primes_for, residues, scores, usable

SCHEMA = "vec_id long, label int, vector array<long>, score string, row int, n int, place int"


def brute_force(rows, step=100, positives=5, negatives=10, low=30, high=90):
    """``rows``: (vec_id, label, vector); every row is one of its own, also if it repeats."""
    rows = [r for r in rows if None not in r]
    out = []
    for i, (anchor, label, vector) in enumerate(rows):
        if anchor % step:
            continue
        scored = sorted((-sum(a * b for a, b in zip(vector, v)), x, n) for j, (x, n, v) in enumerate(rows) if j != i)
        for s, positive, _ in [r for r in scored if r[2] == label][:positives]:
            window = [r for r in scored if r[2] != label and low * -s <= 100 * -r[0] <= high * -s]
            out += [(anchor, positive, rank, x, -s, -t) for rank, (t, x, _) in enumerate(window[:negatives], 1)]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, "s", 1, 2, 3) for r in rows], SCHEMA).repartition(3)


def mined(docs, step=100, **options):
    return [tuple(r) for r in mine_hard_negatives(docs, F.col("vec_id") % step == 0, **options).collect()]


@pytest.mark.parametrize("width,size", [(1, 5), (3, 10**6), (64, 300), (150, 5000), (200, 10**7)])
def test_scores_are_exact(width, size):
    rng = np.random.default_rng(width)
    a, b = rng.integers(-size, size + 1, (7, width)), rng.integers(-size, size + 1, (9, width))
    a[0] = b[0] = size
    b[1] = -size
    primes = primes_for(width * size * size)
    found = scores(residues(a, primes), residues(b, primes), primes)
    expected = [[sum(int(x) * int(y) for x, y in zip(u, v)) for v in b] for u in a]
    assert found.tolist() == expected


def test_too_large_scores():
    assert primes_for(0) == PRIMES[:1]
    with pytest.raises(ArithmeticError):
        primes_for(10**18)


def test_matches_brute_force_on_the_table(spark):
    rows = []
    for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect():
        label = (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label
        rows.append((r.vec_id, label, [int(np.floor(256 * float(x))) for x in r.embedding]))
    found = [tuple(r) for r in op11_hard_negatives(spark, SF).collect()]
    assert found
    same(found, brute_force(rows))


@pytest.mark.parametrize("blocks", [{}, {"row_block": 7, "anchor_block": 3}])
def test_awkward_rows(spark, blocks):
    """Repeated rows and ids, null columns, lengths that differ, ties, negative scores, a hot label."""
    rng = random.Random(3)
    rows = [(i, rng.choice([0, 0, 0, 1, 2]), [rng.randrange(-3, 6) for _ in range(rng.choice([0, 2, 4, 4, 4]))]) for i in range(60)]
    rows += [rows[0]] * 3 + [rows[10]] * 2 + [rows[13]] * 12 + [(20, 1, [9, 9])]
    rows += [(None, 1, [1, 1]), (61, None, [1, 1]), (70, 1, None), (80, 3, [1, 1, 1, 1]), (-10, 0, [4, 4, 4, 4])]
    found = mined(frame(spark, rows), 10, **blocks)
    assert found
    same(found, brute_force(rows, 10))


def test_other_limits(spark):
    rows = [(i, i % 3, [i % 5, i % 7, i % 4]) for i in range(50)]
    found = mined(frame(spark, rows), 5, positives=2, negatives=3, low=10, high=100)
    same(found, brute_force(rows, 5, 2, 3, 10, 100))


def test_many_copies_of_an_anchor(spark):
    assert COPIES < 70_000
    rows = spark.range(70_000).selectExpr("0L as vec_id", "1 as label", "array(2L) as vector")
    rows = rows.unionByName(spark.sql("select 1L as vec_id, 2 as label, array(1L) as vector"))
    found = mine_hard_negatives(rows, F.col("vec_id") == 0, positives=1, negatives=1)
    assert [tuple(r) for r in found.groupBy(*found.columns).count().collect()] == [(0, 0, 1, 1, 4, 2, 70_000)]


def test_empty(spark):
    assert mined(frame(spark, [])) == []
    assert mined(frame(spark, [(1, 1, [1])])) == []


def test_integers_and_usable(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [None, [], [0.5, -0.001], [1.0, None], [nan], [inf], [-inf, 1.0]]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "i int, v array<float>").filter(usable(F.col("v")))
    assert sorted(tuple(r) for r in df.select("i", integers(F.col("v"))).collect()) == [(1, []), (2, [128, -1])]
