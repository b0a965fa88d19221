"""Operator 6: BPE encoding and decoding with forced-boundary splitting.

A merge only makes tokens of the vocabulary, so two neighbouring bytes that stand next to each
other in no token are never joined: the text may be cut between them for certain, each fragment
encoded alone, and the ids put in a row.  The pairs that do occur are read off the vocabulary.
A blank is in no token beside another byte, so every blank is such a cut; fragments between
blanks are looked up in a bounded memo.  The new ones of a batch are pre-tokenised and cut at the
other forced boundaries together; these smaller fragments have a memo of their own, and only new
ones are merged.  Where the model marks the end of a word, only the last fragment of a pre-token
carries the mark.

Normalisation, pre-tokenisation and merging are the installed library's, built from a tokenizer
file whose content is sent to the executors (under 2 MB; other files may be larger, but a
vocabulary has a fixed size).  Texts are never shuffled, and hot texts, words or sources make
no difference.

Defined cases: null and empty texts have no tokens and decode to an empty text; the strings of
special tokens become their ids, as in the library; repeated rows get a row each; null ids stay
null; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import json
import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from tokenizers import Tokenizer, models

from millrace.llm.blocks import pieces, ship

ship(__name__)

MEMO = 250_000

# On ASCII text these three steps are Python's lower() and the blanks below.
SIMPLE_STEPS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
ASCII_BLANKS = re.compile("[ \t\n\v\f\r]+")


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: itself if it prints, else 256 and up."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


def joined_pairs(vocabulary, suffix: str) -> set[str]:
    """Neighbouring letters of any token, with and without the end-of-word mark taken off."""
    pairs = set()
    for token in vocabulary:
        bare = token.removesuffix(suffix) if suffix else token
        for form in {bare, token if len(bare) == 0 else bare}:
            pairs.update(map("".join, zip(form, form[1:])))
    return pairs


class ForcedBoundaryEncoder:
    """Token ids of texts, equal to the library's for the same file."""

    def __init__(self, content: str, memo: int = MEMO):
        spec = json.loads(content)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("byte_fallback") or model.get("ignore_merges") or model.get("continuing_subword_prefix"):
            raise ValueError("a plain byte-level BPE file is needed")
        self.whole = Tokenizer.from_str(content)
        self.suffix = model.get("end_of_word_suffix") or ""
        self.pairs = joined_pairs(model["vocab"], self.suffix)
        blank = byte_letters()[32]
        if any(blank in pair for pair in self.pairs):
            raise ValueError("tokens of this file join blanks to other bytes")
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.last = models.BPE(vocab=model["vocab"], merges=merges, end_of_word_suffix=self.suffix or None)
        self.inner = models.BPE(vocab=model["vocab"], merges=merges)
        self.special = {}
        for token in spec["added_tokens"]:
            if token["normalized"] or token["single_word"] or token["lstrip"] or token["rstrip"]:
                raise ValueError("added tokens with conditions are not handled")
            self.special[token["content"]] = np.int32(token["id"]).tobytes()
        longest = sorted(map(re.escape, self.special), key=len, reverse=True)
        self.cut = re.compile(f"({'|'.join(longest)})") if longest else None
        steps = (spec.get("normalizer") or {}).get("normalizers")
        self.simple = steps == SIMPLE_STEPS
        self.memo = self._fresh_memo()
        self.pieces: dict[tuple[str, bool], bytes] = {}
        self.size = memo
        self.code = np.zeros(512, np.int64)
        self.code[[ord(c) for c in byte_letters()]] = np.arange(256)
        self.joined = np.zeros((256, 256), bool)
        for one, two in self.pairs:
            self.joined[self.code[ord(one)], self.code[ord(two)]] = True

    def _piece(self, letters: str, last: bool) -> bytes:
        """Ids of a fragment that has no forced boundary inside, at the end of a pre-token or before."""
        model = self.last if last else self.inner
        return array("i", [t.id for t in model.tokenize(letters)]).tobytes()

    def fragments(self, texts: list[str]) -> list[bytes]:
        """Ids of normalised texts without blanks, all cut at the forced boundaries in one pass."""
        found = self.whole.pre_tokenizer.pre_tokenize_str(" ".join(texts))
        if not found:
            return [b""] * len(texts)
        starts = np.cumsum([0, *(len(t) + 1 for t in texts)])
        owner = np.searchsorted(starts, [span[0] for _, span in found], side="right") - 1
        letters = "".join([piece for piece, _ in found])
        ends = np.cumsum([len(piece) for piece, _ in found])
        code = self.code[np.frombuffer(letters.encode("utf-16-le"), np.uint16)]
        cuts = np.flatnonzero(~self.joined[code[:-1], code[1:]]) + 1
        cuts = np.union1d(cuts, ends)
        last = np.isin(cuts, ends, assume_unique=True)
        owner = owner[np.searchsorted(ends, cuts)]
        pieces_, start = self.pieces, 0
        out = []
        for end, whole in zip(cuts.tolist(), last.tolist(), strict=True):
            key = (letters[start:end], whole)
            ids = pieces_.get(key)
            if ids is None:
                ids = pieces_[key] = self._piece(*key)
            out.append(ids)
            start = end
        first = np.searchsorted(owner, np.arange(len(texts) + 1)).tolist()
        return [b"".join(out[x:y]) for x, y in zip(first, first[1:])]

    def _plain(self, text: str) -> list[str]:
        """The fragments between blanks of a normalised text."""
        if self.simple and text.isascii():
            return ASCII_BLANKS.split(text.lower())
        return self.whole.normalizer.normalize_str(text).split(" ") if self.whole.normalizer else text.split(" ")

    def _split(self, text: str) -> list[str]:
        """Fragments of a text; special tokens are fragments of their own, behind a blank as their mark.

        Plain fragments have no blank.  Normalising can make one spell a special token, as lower
        case does, but the library looks for these in the raw text only.
        """
        if self.cut is None or not any(map(text.__contains__, self.special)):
            return self._plain(text)
        # every other part is what the expression found
        parts = [[" " + part] if i % 2 else self._plain(part) for i, part in enumerate(self.cut.split(text))]
        return [f for part in parts for f in part]

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as 32-bit integers in a row."""
        split = [self._split(text) for text in texts]
        new = {f for part in split for f in part if f not in self.memo}
        if len(self.memo) + len(new) > self.size:
            self.memo = self._fresh_memo()
            new = {f for part in split for f in part if f not in self.memo}
        if len(self.pieces) > self.size:
            self.pieces = {}
        if new:
            new = list(new)
            self.memo.update(zip(new, self.fragments(new), strict=True))
        memo = self.memo
        return [b"".join([memo[f] for f in part]) for part in split]

    def _fresh_memo(self) -> dict[str, bytes]:
        return {"": b"", **{" " + token: ids for token, ids in self.special.items()}}


def _encode_rows(content):
    def run(batches):
        encoder = ForcedBoundaryEncoder(content.value)
        for batch in batches:
            for part in pieces(batch):
                ids = encoder.encode_batch([text or "" for text in part.column("text").to_pylist()])
                ends = np.cumsum([0, *(len(x) // 4 for x in ids)], dtype=np.int32)
                values = pa.array(np.frombuffer(b"".join(ids), np.int32))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends), values)], ["doc_id", "ids"])

    return run


def _decode_rows(content):
    def run(batches):
        whole = Tokenizer.from_str(content.value)
        if whole.decoder is not None:
            raise ValueError("files with a decoder are not handled")
        names = [whole.id_to_token(i) or "" for i in range(whole.get_vocab_size())]
        for batch in batches:
            # an id list is about as long as its text
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                texts = [" ".join([names[x] for x in ids.values.to_numpy()]) if ids.is_valid else "" for ids in part.column("ids")]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("ids"), pa.array(texts, pa.string())], ["doc_id", "ids", "decoded"])

    return run


def _content(spark: SparkSession, tokenizer_path: str):
    with open(tokenizer_path, encoding="utf-8") as file:
        return spark.sparkContext.broadcast(file.read())


def encode(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """``doc_id`` and ``ids``, the token ids of the whole text without added ones."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_encode_rows(_content(docs.sparkSession, tokenizer_path)), "doc_id long, ids array<int>")


def decode(encoded: DataFrame, tokenizer_path: str) -> DataFrame:
    """``doc_id``, ``ids`` and ``decoded``, the text of the ids with special tokens."""
    rows = encoded.select("doc_id", "ids")
    return rows.mapInArrow(_decode_rows(_content(encoded.sparkSession, tokenizer_path)), "doc_id long, ids array<int>, decoded string")


def round_trip(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """``doc_id``, ``ids`` and ``decoded``: both steps in one task, a piece of the texts at a time."""
    content = _content(docs.sparkSession, tokenizer_path)
    first, then = _encode_rows(content), _decode_rows(content)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(lambda batches: then(first(batches)), "doc_id long, ids array<int>, decoded string")


def digests(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Counts and digests of the ids and of the text they decode to."""
    done = round_trip(docs, tokenizer_path)
    numbers = F.array_join(F.col("ids").cast("array<string>"), " ")
    return done.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(numbers.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def word_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op6_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), word_bpe_path())
