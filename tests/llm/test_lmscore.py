"""Operator 13 against counts in dictionaries, and its tries against plain sets."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest_llm import SF
from pyspark.sql import functions as F

from millrace.llm.eliasfano import OPEN, STEP, Sequence, Trie, grouped, logarithm, quantised
from millrace.llm.lmscore import PRIOR2, PRIOR3, op13_lm_scoring, score_documents


def tokens_of(text):
    return (text or "").encode().lower().split() + [b"\n"]


def brute_force(rows, prior2=PRIOR2, prior3=PRIOR3):
    """(doc_id, held_out, tokens, known, training tokens, base score, score) of (doc_id, text, held_out) rows."""
    c1, c2, c3, before1, before2 = (Counter() for _ in range(5))
    texts = [(d, bool(h), [b" ", b" ", *tokens_of(t)]) for d, t, h in rows]
    for _, held_out, v in texts:
        for a, b, c in zip(v, v[1:], v[2:]):
            if not held_out:
                c1[c] += 1
                c2[b, c] += 1
                c3[a, b, c] += 1
                before1[b] += 1
                before2[a, b] += 1
    n, size = sum(c1.values()), len(c1)
    out = []
    for d, held_out, v in texts:
        base = score = 0
        for a, b, c in zip(v, v[1:], v[2:]):
            p1 = (c1[c] + 0.1) / (n + 0.1 * (size + 1))
            p2 = (c2[b, c] + prior2 * p1) / (before1[b] + prior2)
            base += math.log10(p1)
            score += math.log10((c3[a, b, c] + prior3 * p2) / (before2[a, b] + prior3))
        out.append((d, held_out, len(v) - 2, sum(c1[c] > 0 for c in v[2:]), n, base, score))
    return out


def compare(found, expected):
    order = lambda r: (repr(r[:5]), r[5], r[6])
    assert len(found) == len(expected)
    for a, b in zip(sorted(map(tuple, found), key=order), sorted(expected, key=order), strict=True):
        assert a[:5] == b[:5]
        assert a[5] == pytest.approx(b[5], abs=1e-6)
        # a code is half a step wrong at most, and a token has two
        assert abs(a[6] - b[6]) <= 1 / STEP * a[2] + 1e-6


def with_fold(rows):
    return [(d, t, d is not None and zlib.crc32(str(d).encode()) % 10 == 0) for d, t in rows]


def test_query(spark, documents):
    expected = brute_force(with_fold(documents))
    compare(op13_lm_scoring(spark, SF).collect(), expected)
    better = [(r[6] - r[5]) / r[2] for r in expected if r[1]]
    assert sum(better) > 0.2 * len(better)


@pytest.mark.parametrize("options", [{}, {"piece_bytes": 500, "shard_tokens": 700, "word_tokens": 300, "split": 40}])
def test_awkward(spark, awkward, empty, options):
    """Words that are dealt over shards, also the begin mark, give the same scores."""
    docs, rows = awkward
    odd = F.col("doc_id") % 3 == 0
    compare(score_documents(docs.withColumn("held_out", odd), **options).collect(), brute_force([(d, t, d is not None and d % 3 == 0) for d, t in rows]))
    assert score_documents(empty.withColumn("held_out", odd), **options).collect() == []


def test_one_word_everywhere(spark):
    rows = [(i, "the " * (i % 50) + f"w{i % 7} the", i % 4 == 0) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, held_out boolean").repartition(6)
    compare(score_documents(docs, piece_bytes=2000, shard_tokens=500, split=100).collect(), brute_force(rows))


def test_nothing_to_learn_from(spark):
    rows = [(1, "a b", True), (2, None, True)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, held_out boolean")
    assert sorted(tuple(r) for r in score_documents(docs).collect()) == [(1, True, 3, 0, 0, 0.0, 0.0), (2, True, 1, 0, 0, 0.0, 0.0)]


@pytest.mark.parametrize("seed", range(12))
def test_sequences(seed):
    rng = random.Random(seed)
    universe = rng.choice([1, 2, 63, 64, 1000, 10**6, 2**40])
    values = np.array(sorted(rng.randrange(universe) for _ in range(rng.choice([0, 1, 5, 64, 700]))), np.int64)
    found = Sequence.encode(values, universe)
    found = Sequence.of(*found.arrays())
    assert found[np.arange(len(values))].tolist() == values.tolist()
    distinct = np.unique(values)
    found = Sequence.encode(distinct, universe)
    asked = np.unique(np.concatenate([distinct, distinct + 1, distinct - 1, [0, universe - 1, universe, -1, universe * 2]]))
    where = {v: i for i, v in enumerate(distinct.tolist())}
    assert found.find(asked).tolist() == [where.get(x, -1) for x in asked.tolist()]


def test_compact():
    values = np.sort(np.random.default_rng(1).choice(10**9, 100_000, replace=False))
    found = Sequence.encode(values, 10**9)
    bits = 8 * sum(a.nbytes for a in (found.low, found.high, found.ones)) / len(values)
    assert bits < 2 + math.log2(10**9 / len(values)) + 4


def test_grouped():
    key = np.array([5, 3, 5, 9, 3, 3])
    at, of = grouped(key)
    assert key[at].tolist() == [3, 5, 9] and key[at][of].tolist() == key.tolist()
    assert [x.tolist() for x in grouped(key[:0])] == [[], []]


def test_logarithms():
    values = np.array([1.0, 1e-9, 0.5, 3e6, 1e-300, 1e300])
    back = logarithm(quantised(values))
    assert np.abs(back - np.log10(values))[:4].max() <= 0.5 / STEP
    assert (quantised(values) < OPEN).all()


def test_trie_in_a_file(tmp_path):
    """Every entry, every way down, and the same from a memory-mapped file."""
    rng = random.Random(4)
    counts = Counter(tuple(rng.randrange(9) for _ in range(3)) for _ in range(300))
    grams = sorted(counts)
    first, middle, last = (np.array(c) for c in zip(*grams, strict=True))
    n = np.array([counts[g] for g in grams], float)
    of_middle = Counter()
    for g, v in counts.items():
        of_middle[g[1]] += v
    total = np.array([of_middle[g[1]] for g in grams])
    (tmp_path / "trie").write_bytes(Trie.build(first, middle, last, n, (last + 1) / 60, total, 7.0, 3.0))
    trie = Trie(np.memmap(tmp_path / "trie", mode="r"))
    assert not trie.words.low.flags.owndata and not trie.trigram_code.flags.owndata
    asked = np.array([(a, b, c) for a in range(11) for b in range(11) for c in range(11)])
    rng.shuffle(asked)
    codes, weights = trie.codes(*asked.T)
    code_of = lambda x: int(quantised(np.array([x]))[0])
    for (a, b, c), code, weight in zip(asked.tolist(), codes.tolist(), weights.tolist(), strict=True):
        of_pair = sum(v for g, v in counts.items() if g[1:] == (b, c))
        if not of_pair:
            assert (code, weight) == (OPEN, OPEN)
            continue
        p2 = (of_pair + 7 * (c + 1) / 60) / (of_middle[b] + 7)
        assert (code, weight) == (code_of(p2 + counts[a, b, c] / 3), code_of(3 / (of_pair + 3)))


def test_empty_trie():
    none = np.zeros(0, np.int64)
    trie = Trie(Trie.build(none, none, none, none, none, none, 1.0, 1.0))
    assert [x.tolist() for x in trie.codes(np.array([1]), np.array([2]), np.array([3]))] == [[OPEN], [OPEN]]
