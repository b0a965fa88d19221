"""Operator 2 against every window looked up one by one."""

import re
from collections import defaultdict
from string import ascii_lowercase, ascii_uppercase

import pytest

from conftest_llm import SF, same

from millrace.llm.winnowing import decontaminate

LOWER = str.maketrans(ascii_uppercase, ascii_lowercase)
ITEMS = [
    (1, "the of the of you idiot and ß 日本 no"), (2, None), (3, ""), (4, "!!"), (5, "Two words"), (6, "ONE"),
    (None, "null id text"), (7, "two words"), (7, "changed"), (8, "a a a a a a a a a a a a"), (9, "it's"),
]


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute_force(rows, items, window):
    known = defaultdict(set)
    for item_id, text in items:
        w = words(text)
        size = min(window, len(w))
        for i in range(len(w) - size + 1 if size else 0):
            known[tuple(w[i : i + size])] |= set() if item_id is None else {str(item_id)}
    sizes = {len(k) for k in known}
    out = []
    for doc_id, text in rows:
        w = words(text)
        hit, found = [False] * len(w), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                if (k := tuple(w[i : i + size])) in known:
                    hit[i : i + size] = [True] * size
                    found |= known[k]
        out.append((doc_id, len(w), sum(hit), len(found), sorted(found), any(hit)))
    return out


def digest(df):
    return [(r.doc_id, r.n_words, r.n_hit, r.n_items, list(r.item_ids), r.contaminated) for r in df.collect()]


@pytest.fixture(scope="module")
def benchmarks(spark, documents):
    table = spark.read.parquet(f"{SF}/benchmark.parquet")
    # parts of documents, so that there are hits; the shared words of the awkward texts
    cut = [(100 + i, " ".join(words(text)[5:30])) for i, (_, text) in enumerate(documents[:40])]
    rows = ITEMS + cut
    return {
        "table": (table, [(r.item_id, r.text) for r in table.collect()]),
        "awkward": (spark.createDataFrame([(*r, "k", 1) for r in rows], "item_id long, text string, window string, length int"), rows),
    }


@pytest.mark.parametrize("broadcast_rows", [1 << 19, 0])
@pytest.mark.parametrize("items", ["table", "awkward"])
@pytest.mark.parametrize("case", ["table", "awkward"])
def test_matches_brute_force(cases, benchmarks, case, items, broadcast_rows):
    docs, rows = cases[case]
    bench, bench_rows = benchmarks[items]
    found = decontaminate(docs, bench, broadcast_rows=broadcast_rows)
    same(digest(found), brute_force(rows, bench_rows, 10))


def test_other_window(cases, benchmarks):
    docs, rows = cases["table"]
    bench, bench_rows = benchmarks["awkward"]
    same(digest(decontaminate(docs, bench, window=5)), brute_force(rows, bench_rows, 5))


def test_empty(spark, empty, cases, benchmarks):
    assert decontaminate(empty, benchmarks["awkward"][0]).collect() == []
    none = spark.createDataFrame([], "item_id long, text string")
    assert not decontaminate(cases["awkward"][0], none).filter("contaminated or n_hit > 0 or n_items > 0").collect()


def test_no_python_in_the_plan(cases, benchmarks, plan):
    assert "Python" not in plan(decontaminate(cases["table"][0], benchmarks["table"][0]))
