"""Operator 10: edit-aware token counts on segment trees of pre-tokens.

No pre-token holds white space after another character, so before such white space a text may be
cut, and the token counts of the parts add up to that of the whole.  Leaves are stretches of
pre-tokens between such cuts, of about ``leaf_chars`` characters.  Over them two segment trees,
kept as columns beside the text, hold characters and tokens.  An edit descends by characters to the
leaves it touches.  A cut stays valid if the characters on both its sides are untouched and still
neighbours, so the leaves between the nearest valid cuts are joined, encoded again, and the sums
above them updated.  A leaf that has grown to four times its size is cut again.

The state is a table with a row for each document; nothing is shuffled, and a task holds one text
at a time.

Defined cases: a null text is an empty one; an empty text has one empty leaf; edits are applied
in the order of their list, each to the text the one before has left; places beyond the end
mean the end, a null or negative start the beginning, a stop before its start the start; a null
insert is empty, and null edits or lists are none; repeated rows each keep a tree; null ids
stay null; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import re

import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.llm.blocks import pieces, ship

ship(__name__)

LEAF_CHARS = 512
CUT = re.compile(r"(?<=\w)[ \n\t]")

STATE = "doc_id long, text string, chars array<int>, tokens array<int>"


def pre_token_cuts(text: str, leaf_chars: int) -> list[int]:
    """Ends of the leaves of a text."""
    ends, at = [], 0
    while at + leaf_chars < len(text) and (found := CUT.search(text, at + leaf_chars)):
        at = found.start()
        ends.append(at)
    return [*ends, len(text)]


class SumTree:
    """Sums over leaves in heap order: the root at 1, the children of i at 2i and 2i+1."""

    def __init__(self, leaves: list[int] | None = None, nodes: list[int] | None = None):
        if nodes is None:
            size = 1
            while size < len(leaves):
                size *= 2
            nodes = [0] * size + leaves + [0] * (size - len(leaves))
            for i in range(size - 1, 0, -1):
                nodes[i] = nodes[2 * i] + nodes[2 * i + 1]
        self.nodes = nodes

    @property
    def total(self) -> int:
        return self.nodes[1]

    def set(self, leaf: int, value: int) -> None:
        i = leaf + len(self.nodes) // 2
        change = value - self.nodes[i]
        while i:
            self.nodes[i] += change
            i //= 2

    def find(self, place: int) -> tuple[int, int]:
        """The leaf that holds a place (the last that is not empty, beyond the end), and where it begins."""
        i, start, half = 1, 0, len(self.nodes) // 2
        place = min(place, self.total - 1)
        while i < half:
            i *= 2
            if place >= start + self.nodes[i]:
                start += self.nodes[i]
                i += 1
        return i - half, start

    def leaves(self) -> list[int]:
        return self.nodes[len(self.nodes) // 2 :]


class CountedText:
    """A text with its two trees."""

    def __init__(self, encoding, leaf_chars: int, text: str, chars=None, tokens=None):
        self.encoding, self.leaf_chars, self.text, self.encoded = encoding, leaf_chars, text, 0
        if chars is None:
            ends = pre_token_cuts(text, leaf_chars)
            starts = [0, *ends[:-1]]
            chars = SumTree([b - a for a, b in zip(starts, ends, strict=True)])
            tokens = SumTree([self.count(text[a:b]) for a, b in zip(starts, ends, strict=True)])
        self.chars, self.tokens = chars, tokens

    def count(self, part: str) -> int:
        self.encoded += len(part)
        return len(self.encoding.encode_ordinary(part))

    def edit(self, start: int, stop: int, insert: str) -> None:
        text = self.text
        start = min(max(start, 0), len(text))
        stop = min(max(stop, start), len(text))
        self.text = text[:start] + insert + text[stop:]
        # the cut before a leaf needs its two neighbours, so the characters beside the edit count too
        first, begin = self.chars.find(max(start - 1, 0))
        last, last_begin = self.chars.find(min(stop, max(len(text) - 1, 0)))
        sizes = self.chars.nodes[len(self.chars.nodes) // 2 :]
        end = last_begin + sizes[last] + len(self.text) - len(text)
        part = self.text[begin:end]
        if len(part) > 4 * self.leaf_chars:
            ends = pre_token_cuts(part, self.leaf_chars)
            cuts = list(zip([0, *ends[:-1]], ends, strict=True))
            counts = [self.count(part[a:b]) for a, b in cuts]
            tokens = self.tokens.leaves()
            self.tokens = SumTree(tokens[:first] + counts + tokens[last + 1 :])
            self.chars = SumTree(sizes[:first] + [b - a for a, b in cuts] + sizes[last + 1 :])
            return
        for tree, value in ((self.chars, len(part)), (self.tokens, self.count(part))):
            tree.set(first, value)
            for leaf in range(first + 1, last + 1):
                tree.set(leaf, 0)


def _encoding(ranks: dict[bytes, int], pattern: str):
    return tiktoken.Encoding("counting", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def _state_rows(shared, leaf_chars):
    def run(batches):
        encoding = _encoding(*shared.value)
        for batch in batches:
            for part in pieces(batch):
                texts = [text or "" for text in part.column("text").to_pylist()]
                counted = [CountedText(encoding, leaf_chars, text) for text in texts]
                trees = [pa.array([getattr(c, t).nodes for c in counted], pa.list_(pa.int32())) for t in ("chars", "tokens")]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(texts, pa.string()), *trees], ["doc_id", "text", "chars", "tokens"])

    return run


def _edited_rows(shared, leaf_chars):
    def run(batches):
        encoding = _encoding(*shared.value)
        for batch in batches:
            for part in pieces(batch):
                done, encoded = [], []
                for row in part.select(["text", "chars", "tokens", "edits"]).to_pylist():
                    counted = CountedText(encoding, leaf_chars, row["text"], SumTree(nodes=row["chars"]), SumTree(nodes=row["tokens"]))
                    for edit in row["edits"] or ():
                        if edit:
                            start = edit["start"] or 0
                            counted.edit(start, start if edit["stop"] is None else edit["stop"], edit["insert"] or "")
                    done.append(counted)
                    encoded.append(counted.encoded)
                trees = [pa.array([getattr(c, t).nodes for c in done], pa.list_(pa.int32())) for t in ("chars", "tokens")]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([c.text for c in done], pa.string()), *trees, pa.array(encoded, pa.int64())],
                    ["doc_id", "text", "chars", "tokens", "n_encoded"],
                )

    return run


def _shared(spark: SparkSession, ranks_path: str, pattern: str):
    with open(ranks_path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return spark.sparkContext.broadcast((ranks, pattern))


def n_tokens() -> Column:
    """A document's token count: the root of its tree."""
    return F.get("tokens", F.lit(1)).cast("long")


def build_trees(docs: DataFrame, ranks_path: str, pattern: str, leaf_chars: int = LEAF_CHARS) -> DataFrame:
    """The state: ``doc_id``, ``text``, and the trees ``chars`` and ``tokens``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_state_rows(_shared(docs.sparkSession, ranks_path, pattern), leaf_chars), STATE)


def apply_edits(state: DataFrame, ranks_path: str, pattern: str, leaf_chars: int = LEAF_CHARS) -> DataFrame:
    """The state after the edits of its column ``edits``, and ``n_encoded``, the characters encoded for it.

    ``edits`` is an array of structs: ``start`` and ``stop`` (characters, end excluded) and ``insert``.
    """
    rows = state.select("doc_id", "text", "chars", "tokens", F.col("edits").cast("array<struct<start:long,stop:long,insert:string>>").alias("edits"))
    return rows.mapInArrow(_edited_rows(_shared(state.sparkSession, ranks_path, pattern), leaf_chars), STATE + ", n_encoded long")


def sample_edits(text: Column) -> Column:
    """Three edits that a text's own content decides: a cut, an insertion and a new end."""
    n = F.length(text).cast("long")

    def edit(start, stop, insert):
        return F.struct(start.cast("long").alias("start"), stop.cast("long").alias("stop"), insert.alias("insert"))

    quarter, half = F.floor(n / 4), F.floor(n / 2)
    return F.array(
        edit(quarter, quarter + 20, F.lit("")),
        edit(half, half, F.concat(F.lit("(see "), F.substring(text, 1, 40), F.lit(")"))),
        edit(F.greatest(n - 30, F.lit(0)), n + 100, F.lit("\n\nEnd of text.")),
    )


def byte_bpe() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document before and after three edits, and what had to be encoded again."""
    before = build_trees(spark.read.parquet(f"{sf_dir}/documents.parquet"), *byte_bpe())
    edited = apply_edits(before.withColumn("edits", sample_edits(F.col("text"))), *byte_bpe())
    return edited.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        n_tokens().alias("n_tokens"),
        "n_encoded",
        F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"),
    )
