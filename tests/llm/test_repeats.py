"""Operator 1 against windows counted one by one."""

from collections import Counter
from hashlib import sha256

import pytest
from conftest_llm import same

from millrace.llm.repeats import remove_repeats

COLUMNS = ["doc_id", "n_words", "n_removed", "kept_text"]


def brute_force(rows, window):
    words = [(text or "").encode().split() for _, text in rows]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (doc_id, _), w in zip(rows, words, strict=True):
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g).decode()
        out.append((doc_id, len(w), sum(gone), sha256(kept.encode()).hexdigest()))
    return out


def digest(df):
    return [(r.doc_id, r.n_words, r.n_removed, sha256(r.kept_text.encode()).hexdigest()) for r in df.select(COLUMNS).collect()]


@pytest.mark.parametrize("case", ["table", "awkward"])
@pytest.mark.parametrize("window,gram,block_bytes", [(35, 8, 1 << 20), (35, 8, 5_000), (12, 3, 20_000)])
def test_matches_brute_force(cases, case, window, gram, block_bytes):
    docs, rows = cases[case]
    same(digest(remove_repeats(docs, window, gram, block_bytes)), brute_force(rows, window))


def test_spans_are_what_is_removed(cases):
    for row in remove_repeats(cases["awkward"][0]).collect():
        assert sum(s.end - s.start for s in row.spans) == row.n_removed
        assert len(row.kept_text.encode().split()) == row.n_words - row.n_removed


def test_empty(empty):
    assert remove_repeats(empty).collect() == []
