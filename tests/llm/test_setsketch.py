"""Operator 5 against all pairs."""

from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest
from conftest_llm import same

from millrace.llm import setsketch
from millrace.llm.components import components
from millrace.llm.setsketch import Likeness, joint_likelihood, near_duplicates, registers, spanning_links

LIKE = Likeness(shingle=3, percent=85)


def shingles(text, size=3):
    words = (text or "").encode().lower().split()
    if len(words) < size:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def closure(names, links):
    root = {n: n for n in names}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        root[find(a)] = find(b)
    return {n: find(n) for n in names}


def linked(a, b, percent=85):
    both = len(a & b)
    return both > 0 and 100 * both >= percent * (len(a) + len(b) - both)


def brute_force(rows, size=3, percent=85):
    sets = [shingles(text, size) for _, text in rows]
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    pairs = {p for h in holders.values() for p in combinations(h, 2)}
    of = closure(range(len(rows)), [p for p in pairs if linked(sets[p[0]], sets[p[1]], percent)])
    least = {}
    for i, r in of.items():
        if rows[i][0] is not None:
            least[r] = min(rows[i][0], least.get(r, rows[i][0]))
    return [(row[0], len(sets[i]), least.get(of[i]), row[0] == least.get(of[i])) for i, row in enumerate(rows)]


def digest(df):
    return [tuple(r) for r in df.select("doc_id", "n_shingles", "component_id", "kept").collect()]


@pytest.mark.parametrize("case", ["table", "awkward"])
def test_matches_brute_force(cases, case):
    docs, rows = cases[case]
    same(digest(near_duplicates(docs, LIKE)), brute_force(rows))


@pytest.mark.parametrize("pivots", [1, 4])
def test_small_blocks(cases, monkeypatch, pivots):
    monkeypatch.setattr(setsketch, "MOST_SKETCHES", 4)
    monkeypatch.setattr(setsketch, "MOST_SHINGLES", 100)
    monkeypatch.setattr(setsketch, "PIVOTS", pivots)
    docs, rows = cases["awkward"]
    same(digest(near_duplicates(docs, LIKE)), brute_force(rows))


@pytest.mark.parametrize("most", [100, 1 << 20])
def test_a_loose_group(spark, monkeypatch, most):
    """Copies with several changed words each: some pairs reach the threshold, many do not."""
    monkeypatch.setattr(setsketch, "MOST_SKETCHES", 8 if most == 100 else 2048)
    monkeypatch.setattr(setsketch, "MOST_SHINGLES", most)
    rng = np.random.default_rng(8)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(60):
        words = list(base)
        for place in rng.choice(60, rng.integers(0, 4), replace=False):
            words[place] = f"x{rng.integers(30)}"
        rows.append((i, " ".join(words)))
    found = digest(near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), LIKE))
    same(found, brute_force(rows))
    assert 1 < len({r[2] for r in found}) < 40


@pytest.mark.parametrize("case", ["table", "awkward"])
def test_five_words_and_four_fifths(cases, case):
    docs, rows = cases[case]
    same(digest(near_duplicates(docs)), brute_force(rows, 5, 80))


def test_bands_follow_the_threshold():
    assert (LIKE.bands, LIKE.registers, Likeness().bands) == (26, 130, 39)
    for percent in (50, 70, 80, 85, 95, 99):
        like = Likeness(percent=percent, rows=3)
        assert (1 - (percent / 100) ** like.rows) ** like.bands <= like.miss
    assert Likeness(percent=100).bands == 1
    with pytest.raises(ValueError):
        _ = Likeness(percent=30).registers


def test_empty(empty):
    assert near_duplicates(empty, LIKE).collect() == []


def test_registers_merge():
    rng = np.random.default_rng(1)
    one, two = (rng.integers(0, 2**64, n, dtype=np.uint64) for n in (3000, 10))
    assert (np.maximum(registers(one, 130), registers(two, 130)) == registers(np.concatenate([one, two]), 130)).all()


@pytest.mark.parametrize("goal", [0.3, 0.6, 0.85, 0.95])
def test_likelihood_finds_the_jaccard_value(goal):
    rng = np.random.default_rng(2)
    grid, found = np.linspace(0, 1, 201), []
    for _ in range(30):
        union = rng.integers(0, 2**64, 2000, dtype=np.uint64)
        cut = int(2000 * (1 - goal) / 2)
        a, b = registers(union[cut:], 130), registers(union[: 2000 - cut], 130)
        n = np.array([2000.0 - cut])
        counts = [np.array([x.sum()]) for x in (a > b, a < b, a == b)]
        found.append(grid[joint_likelihood(n, n, *counts, grid[None, :])[0].argmax()])
    assert abs(np.mean(found) - goal) < 0.03


def test_spanning_links_connect_what_all_links_connect():
    rng = np.random.default_rng(3)
    for _ in range(30):
        base = rng.integers(0, 2**64, 60, dtype=np.uint64)
        sets = []
        for _ in range(40):
            own = base.copy()
            where = rng.choice(60, rng.integers(0, 9), replace=False)
            own[where] = rng.integers(0, 2**64, len(where), dtype=np.uint64)
            sets.append(np.unique(own))
        every = [(i, j) for i, j in combinations(range(40), 2) if linked(set(sets[i].tolist()), set(sets[j].tolist()))]
        links = spanning_links(sets, 85)
        assert all(tuple(sorted(x)) in every for x in links)
        parts = [closure(range(40), x) for x in (every, links)]
        assert len({(parts[0][i], parts[1][i]) for i in range(40)}) == len(set(parts[0].values())) == len(set(parts[1].values()))


def test_components(spark):
    rng = np.random.default_rng(4)
    edges = {tuple(sorted(p)) for p in rng.integers(0, 400, (260, 2)).tolist() if p[0] != p[1]}
    edges |= {(i, i + 1) for i in range(1000, 1040)} | {(2000, 2000 + i) for i in range(1, 50)}
    found = {r.node: r.root for r in components(spark.createDataFrame(sorted(edges), "a long, b long")).collect()}
    of = closure({n for e in edges for n in e}, edges)
    groups = defaultdict(set)
    for node, root in of.items():
        groups[root].add(node)
    assert found.keys() == of.keys()
    assert all({found[n] for n in g} == {min(g)} or len({found[n] for n in g}) == 1 for g in groups.values())
    assert len(set(found.values())) == len(groups)
