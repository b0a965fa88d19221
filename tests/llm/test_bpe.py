"""Operator 6 against the library."""

import random

import pytest
from conftest_llm import same
from tokenizers import Tokenizer

from millrace.llm.bpe import ForcedBoundaryEncoder, decode, digests, encode, joined_pairs, word_bpe_path

ODD = [
    "", "  ", "a", "don't we'll I'D 'S", "abc1234xyz,,,!!!", "<|endoftext|>hi <|startoftext|> <|endoftext|>x", "ΑΣ ΟΔΟΣ İ ǅ",
    "日本語のテキスト", "é ｆｕｌｌ  x​y z\x85q", "🙂👍🏽 CAFÉ", "A" * 300, "\x00 tab\tnew\r\n", "</w> <w> </w", "½ ² Ⅷ ٣", "ﬃ ſ K Å",
    "<|endoftext|", "é" * 50, *[f"x{chr(i)}Y {chr(i)}{chr(i)}z" for i in range(256)],
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(word_bpe_path())


def expected(library, rows):
    out = []
    for doc_id, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        out.append((doc_id, ids, library.decode(ids, skip_special_tokens=False)))
    return out


@pytest.mark.parametrize("case", ["table", "awkward"])
def test_matches_the_library(cases, library, case):
    docs, rows = cases[case]
    found = decode(encode(docs, word_bpe_path()), word_bpe_path()).collect()
    same([(r.doc_id, list(r.ids), r.decoded) for r in found], expected(library, rows))


def test_odd_texts_and_a_small_memo(library):
    encoder = ForcedBoundaryEncoder(open(word_bpe_path(), encoding="utf-8").read(), memo=5)
    rng = random.Random(1)
    ranges = [(32, 127), (128, 0x250), (0x370, 0x600), (0x4E00, 0x4E80), (0x1F300, 0x1F600), (32, 40), (0x300, 0x310)]
    texts = ODD + ["".join(chr(rng.randrange(*rng.choice(ranges))) for _ in range(rng.randrange(40))) for _ in range(2000)]
    for i in range(0, len(texts), 7):
        for text, ids in zip(texts[i : i + 7], encoder.encode_batch(texts[i : i + 7]), strict=True):
            assert memoryview(ids).cast("i").tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_special_tokens_in_other_case_are_plain_text(library):
    encoder = ForcedBoundaryEncoder(open(word_bpe_path(), encoding="utf-8").read())
    texts = ["<|EndOfText|>", "a <|ENDOFTEXT|> b", "<|STARTOFTEXT|> <|startoftext|> <|StartOfText|>", "<|endoftext|><|EndOfText|>", "<|endoftext|> <|endoftext|>"]
    for text, ids in zip(texts, encoder.encode_batch(texts), strict=True):
        assert memoryview(ids).cast("i").tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_forced_boundaries_are_in_no_token():
    assert joined_pairs(["ab", "abc</w>", "d</w>"], "</w>") == {"ab", "bc"}


def test_empty(empty):
    assert digests(empty, word_bpe_path()).collect() == []
