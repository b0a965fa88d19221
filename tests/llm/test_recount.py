"""Operator 10 against counting the whole edited text again."""

import base64
import random

import pytest
from conftest_llm import same
from pyspark.sql import functions as F

from millrace.llm.recount import CountedText, SumTree, _encoding, apply_edits, build_trees, byte_bpe, n_tokens, pre_token_cuts, sample_edits

PIECES = ["a", "b", " ", "  ", "\n", "'s", "'", "1", "22", ",", "é", "日本", "\t", " the", " and", "\r\n", " ", "\x1c", "🙂", "don't", "x"]


@pytest.fixture(scope="module")
def encoding():
    path, pattern = byte_bpe()
    with open(path, "rb") as file:
        return _encoding({base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}, pattern)


def edited(text, edits):
    for start, stop, insert in edits:
        start = min(max(start or 0, 0), len(text))
        stop = min(max(start if stop is None else stop, start), len(text))
        text = text[:start] + (insert or "") + text[stop:]
    return text


@pytest.mark.parametrize("leaf_chars", [4, 16, 50])
def test_random_edits(encoding, leaf_chars):
    rng = random.Random(leaf_chars)
    make = lambda k: "".join(rng.choice(PIECES) for _ in range(rng.randrange(k)))
    for _ in range(500):
        text = make(200)
        counted = CountedText(encoding, leaf_chars, text)
        for _ in range(rng.randrange(8)):
            start = rng.randrange(-2, len(text) + 5)
            edit = start, start + rng.choice([0, 0, 1, 3, 20, -1]), make(rng.choice([1, 5, 60]))
            counted.edit(*edit)
            text = edited(text, [edit])
            assert counted.text == text
            assert counted.chars.total == len(text)
            assert counted.tokens.total == len(encoding.encode_ordinary(text))
            for tree in (counted.chars, counted.tokens):
                assert SumTree(tree.leaves()).nodes == tree.nodes


@pytest.mark.parametrize("case", ["table", "awkward"])
def test_sample_edits(cases, encoding, case):
    docs, rows = cases[case]
    path, pattern = byte_bpe()
    before = build_trees(docs, path, pattern)
    same(
        [(r.doc_id, r.text, r.n) for r in before.withColumn("n", n_tokens()).collect()],
        [(i, t or "", len(encoding.encode_ordinary(t or ""))) for i, t in rows],
    )
    found = apply_edits(before.withColumn("edits", sample_edits(F.col("text"))), path, pattern).withColumn("n", n_tokens()).collect()
    expected = []
    for doc_id, text in rows:
        n = len(text or "")
        after = edited(text or "", [(n // 4, n // 4 + 20, "")])
        after = edited(after, [(n // 2, n // 2, f"(see {(text or '')[:40]})"), (max(n - 30, 0), n + 100, "\n\nEnd of text.")])
        expected.append((doc_id, after, len(encoding.encode_ordinary(after))))
    same([(r.doc_id, r.text, r.n) for r in found], expected)
    long = [r for r in found if len(r.text) > 20_000]
    assert all(r.n_encoded < len(r.text) / 3 for r in long)


def test_odd_edits(spark, encoding):
    path, pattern = byte_bpe()
    lists = [None, [], [None], [(None, None, None)], [(-5, 3, "x")], [(2, 1, "y")], [(10**6, 10**7, "z")], [(0, 10**6, None)], [(0, 0, "w " * 3000)]]
    docs = spark.createDataFrame([(i, "some plain text of a few words " * 40) for i in range(len(lists))], "doc_id long, text string")
    edits = spark.createDataFrame(list(enumerate(lists)), "doc_id long, edits array<struct<start:long,stop:long,insert:string>>")
    found = apply_edits(build_trees(docs, path, pattern).join(edits, "doc_id"), path, pattern).withColumn("n", n_tokens()).collect()
    for row in found:
        after = edited("some plain text of a few words " * 40, [e for e in lists[row.doc_id] or [] if e])
        assert (row.text, row.n) == (after, len(encoding.encode_ordinary(after)))


def test_cuts_cover_the_text():
    text = "ab cd\n" * 500
    ends = pre_token_cuts(text, 64)
    assert ends == sorted(set(ends)) and ends[-1] == len(text)
    assert all(text[e] in " \n" for e in ends[:-1])


def test_empty(empty):
    path, pattern = byte_bpe()
    assert build_trees(empty, path, pattern).collect() == []
