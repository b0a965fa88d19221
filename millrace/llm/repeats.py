"""Operator 1: remove passages that occur more than once, checked again by Aho-Corasick automata.

1. *Anchors.*  In each window of 35 words the smallest 8-word hash is its anchor.  The choice
   depends on the window's words alone, so equal windows have equal anchors, and one row per
   anchor occurrence (about every 15 words) stands for all windows that chose it.
2. *Confirming.*  An anchor that occurs once settles its windows as unique, one whose stretches
   of text all agree settles them as recurring.  Only for the rest are single windows counted,
   by a 128-bit key.
3. *Locating.*  Documents are dealt over blocks of about 1 MB by a hash of their content.  The
   window keys locate the recurring passages of a block.  They are compiled into one automaton
   over word numbers, and all documents of the block are streamed through it; as it is built from
   the same block's passages, it checks what the keys found and finds nothing more.

Counts are summed per block before they are shuffled, so the rows of one very common passage
are at most as many as the blocks; no task ever holds all its occurrences.

Defined cases: null and empty texts have no words, and keep an empty text; texts of under 35
words keep everything; repeated rows are copies of each other; a null ``doc_id`` is kept as it
is; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from millrace.llm.blocks import BLOCK_BYTES, WordBlock, block_count, block_of, merged, ship, sliding

ship(__name__)

WINDOW = 35
GRAM = 8

# Order and place of an 8-word hash, packed: 36 bits and 28 bits.
PLACE = np.uint64((1 << 28) - 1)


class _Windows:
    """The windows of a block and the stretches that share an anchor."""

    def __init__(self, block: WordBlock, window: int, gram: int):
        self.block, self.window = block, window
        self.start = block.window_starts(window)
        if not len(self.start):
            self.first = self.anchor = self.stretch = np.zeros(0, np.int64)
            return
        grams = block.spans(np.arange(len(block.ids) - gram + 1), gram)
        packed = (grams & ~PLACE) | np.arange(len(grams), dtype=np.uint64)
        place = (sliding(np.minimum, packed, window - gram + 1)[self.start] & PLACE).astype(np.int64)
        # the same place is never an anchor in two texts
        self.first = np.concatenate(([0], np.flatnonzero(place[1:] != place[:-1]) + 1))
        self.anchor = grams[place[self.first]].view(np.int64)
        self.stretch = np.repeat(np.arange(len(self.first)), np.diff(np.append(self.first, len(place))))

    def stretch_keys(self) -> np.ndarray:
        start = self.start[self.first]
        windows = np.diff(np.append(self.first, len(self.start)))
        return self.block.spans(start, windows + self.window - 1).view(np.int64)

    def keys(self, chosen: np.ndarray) -> np.ndarray:
        """128-bit keys of the chosen windows, as a structured array."""
        out = np.empty(len(chosen), [("k1", np.int64), ("k2", np.int64)])
        for lane, name in enumerate(out.dtype.names):
            out[name] = self.block.spans(self.start[chosen], self.window, lane).view(np.int64)
        return out


def _anchor_rows(window: int, gram: int):
    def run(table: pa.Table) -> pa.Table:
        found = _Windows(WordBlock(table["text"].to_pylist()), window, gram)
        keys = found.stretch_keys() if len(found.first) else found.anchor
        order = np.lexsort((keys, found.anchor))
        anchor, keys = found.anchor[order], keys[order]
        first = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1])[: len(anchor)])
        counts = np.diff(np.append(first, len(anchor)))
        return pa.table({
            "block": pa.array(np.full(len(first), table["block"][0].as_py(), np.int32)),
            "anchor": anchor[first], "n": counts,
            "least": keys[first], "most": keys[first + counts - 1],
        })

    return run


def _window_rows(window: int, gram: int):
    def run(key, docs: pa.Table, anchors: pa.Table) -> pa.Table:
        block, keys, counts = 0, np.zeros(0, [("k1", np.int64), ("k2", np.int64)]), np.zeros(0, np.int64)
        if docs.num_rows and anchors.num_rows:
            block = docs["block"][0].as_py()
            found = _Windows(WordBlock(docs["text"].to_pylist()), window, gram)
            open_ = np.isin(found.anchor, anchors["anchor"].to_numpy())
            keys, counts = np.unique(found.keys(np.flatnonzero(open_[found.stretch])), return_counts=True)
        return pa.table({
            "block": pa.array(np.full(len(keys), block, np.int32)),
            "k1": keys["k1"].copy(), "k2": keys["k2"].copy(), "n": counts.astype(np.int64),
        })

    return run


def _automaton(block: WordBlock, passages: list[tuple[int, int]]):
    """One automaton over the distinct passages, as sequences of word numbers."""
    shard = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    for a, b in passages:
        shard.add_word(tuple(block.ids[a:b].tolist()), b - a)
    shard.make_automaton()
    return shard


def _recurring(docs: pa.Table, found: _Windows, proofs: pa.Table) -> np.ndarray:
    """Which windows of the block recur, by settled anchors and by window keys."""
    kind = proofs["kind"].to_numpy()
    k1, k2 = proofs["k1"].to_numpy(), proofs["k2"].to_numpy()
    recurs = np.isin(found.anchor, k1[kind == 0])[found.stretch]
    known = np.empty(int((kind == 1).sum()), [("k1", np.int64), ("k2", np.int64)])
    known["k1"], known["k2"] = k1[kind == 1], k2[kind == 1]
    if len(known):
        rest = np.flatnonzero(~recurs)
        recurs[rest] = np.isin(found.keys(rest), known)
    return recurs


def _kept_rows(window: int, gram: int):
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
        ("kept_text", pa.string()),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
    ])

    def run(key, docs: pa.Table, proofs: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return schema.empty_table()
        block = WordBlock(docs["text"].to_pylist())
        found = _Windows(block, window, gram)
        at = found.start[_recurring(docs, found, proofs)] if proofs.num_rows else found.start[:0]
        passages, shard = [], None
        if len(at):
            text_of = np.searchsorted(block.starts, at, side="right")
            cut = np.flatnonzero((np.diff(at) != 1) | (np.diff(text_of) != 0))
            firsts, lasts = at[np.append(0, cut + 1)], at[np.append(cut, len(at) - 1)]
            passages = list(zip(firsts.tolist(), (lasts + window).tolist(), strict=True))
            shard = _automaton(block, passages)
        kept, removed, spans = [], [], []
        for a, b in zip(block.starts[:-1].tolist(), block.starts[1:].tolist(), strict=True):
            hits = list(shard.iter(tuple(block.ids[a:b].tolist()))) if shard and b - a >= window else []
            gone = merged([e + 1 - n for e, n in hits], [e + 1 for e, _ in hits])
            words, last = [], a
            for x, y in gone:
                words += block.words[last : a + x]
                last = a + y
            words += block.words[last:b]
            kept.append(b" ".join(words).decode("utf-8", "surrogatepass"))
            removed.append(b - a - len(words))
            spans.append([{"start": x, "end": y} for x, y in gone])
        return pa.table(
            [docs["doc_id"], pa.array(block.counts), pa.array(removed, pa.int64()), pa.array(kept, pa.string()), pa.array(spans, schema.field("spans").type)],
            schema=schema,
        )

    return run


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Documents without the words of any ``window``-word passage that also starts elsewhere.

    Returns ``doc_id``, ``n_words``, ``n_removed``, ``kept_text`` (the other words, joined by one
    space) and ``spans`` (removed word ranges, end excluded).
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    blocks = rows.withColumn("block", block_of(block_count(rows, block_bytes)))
    # A group of these windows has one row for each block at most, and needs no second shuffle.
    alike, same = Window.partitionBy("anchor"), Window.partitionBy("k1", "k2")
    anchors = blocks.groupBy("block").applyInArrow(
        _anchor_rows(window, gram), "block int, anchor long, n long, least long, most long"
    )
    agree = F.min("least").over(alike) == F.max("most").over(alike)
    shared = anchors.select("block", "anchor", F.sum("n").over(alike).alias("total"), agree.alias("agree")).filter("total > 1")
    windows = (
        blocks.groupBy("block")
        .cogroup(shared.filter("not agree").select("block", "anchor").groupBy("block"))
        .applyInArrow(_window_rows(window, gram), "block int, k1 long, k2 long, n long")
    )
    twice = windows.select("block", "k1", "k2", F.sum("n").over(same).alias("total")).filter("total > 1")
    proofs = shared.filter("agree").select("block", F.lit(0).alias("kind"), F.col("anchor").alias("k1"), F.lit(0).cast("long").alias("k2"))
    proofs = proofs.unionByName(twice.select("block", F.lit(1).alias("kind"), "k1", "k2"))
    return (
        blocks.groupBy("block")
        .cogroup(proofs.groupBy("block"))
        .applyInArrow(
            _kept_rows(window, gram),
            "doc_id long, n_words long, n_removed long, kept_text string, spans array<struct<start:long,end:long>>",
        )
    )


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))
