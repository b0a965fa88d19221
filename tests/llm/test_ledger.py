"""Operator 9 against counts word by word."""

from collections import Counter

import pytest
from conftest_llm import same

from millrace.llm.ledger import BASE, MEASURES, POLICY, RULES, Policy, ablations, fails, mask_of, quality_ledger, with_ledger

SPACE = " \t\n\v\f\r"


def brute_force(rows):
    out = []
    for doc_id, text in rows:
        text = text or ""
        words = text.encode().split()
        windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
        often = Counter(windows)
        repeated = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 8)}
        lines = [x for x in text.split("\n") if x.strip(SPACE)]
        plain = [w.decode() for w in words]
        m = (
            len(words), sum(map(len, plain)), sum(c in "#*$%&|<>" for c in text), len(lines), len(lines) - len(set(lines)), len(repeated),
            sum(not any(c.isalpha() for c in w) for w in plain), sum(x.strip(SPACE)[0] in "-*•‣" for x in lines),
            sum(x.rstrip(SPACE).endswith(("...", "…")) for x in lines), sum(a == b for a, b in zip(words, words[1:])),
        )
        failed = sum(1 << i for i, rule in enumerate(RULES.values()) if eval(rule, dict(zip(MEASURES, m, strict=True))))
        out.append((doc_id, *m, failed))
    return out


@pytest.mark.parametrize("case", ["table", "awkward"])
def test_matches_brute_force(cases, case):
    docs, rows = cases[case]
    same([tuple(r) for r in quality_ledger(docs).collect()], brute_force(rows))


def test_columns_stay(awkward):
    docs, _ = awkward
    found = with_ledger(docs, docs.columns, "mine")
    assert found.columns == [*docs.columns, "mine"]
    assert sorted(map(repr, found.drop("mine").collect())) == sorted(map(repr, docs.collect()))


def test_policies_read_no_text(cases):
    ledger = quality_ledger(cases["table"][0])
    strict, none = Policy("strict", mask_of(*RULES)), Policy("none", 0)
    assert ledger.filter(fails(none)).count() == 0
    assert ledger.filter(fails(BASE)).count() <= ledger.filter(fails(strict)).count()


def test_ablations(cases):
    ledger = quality_ledger(cases["awkward"][0])
    bits = [r.failed for r in ledger.collect()]
    for row in ablations(ledger, POLICY).collect():
        assert row.n_failed == sum(b & row.bit != 0 for b in bits)
        assert row.n_failed_alone == sum(b == row.bit for b in bits)
        assert row.n_kept == sum(b == 0 for b in bits)
        assert mask_of(row.rule) == row.bit


def test_empty(empty):
    assert quality_ledger(empty).collect() == []
    assert ablations(quality_ledger(empty)).collect() == []
