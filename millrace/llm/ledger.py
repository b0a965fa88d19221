"""Operator 9: quality rules as a ledger of failure bits and measurements.

Every text is measured once, in one pass, and every rule is evaluated once; the ledger keeps the
measurements and a bit for each rule that failed.  A policy is a version name and a mask of rules:
applying it, or another one later, is a bitwise AND on the ledger and reads no text.  Ablations
group the ledger by its bits first, so they too cost one narrow aggregate.

Defined cases: null, empty and wordless texts have zero in every measurement and fail
``short_text``; texts of fewer than eight words have no window; repeated rows get a row each; null
ids stay null; an empty table gives an empty ledger; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.llm.blocks import WordBlock, mixed, pieces, ship

ship(__name__)

WINDOW = 8
SPACES = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
BULLETS = ("-", "*", "•", "‣")
ELLIPSES = ("...", "…")

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
    "n_letterless_words", "n_bullet_lines", "n_ellipsis_lines", "n_echoes",
)

# Rule and failure, over the measurements; a rule's bit is its place in this table.
RULES = {
    "short_text": "n_words < 20",
    "repeated_windows": "100 * n_repeat_words > 30 * n_words",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 30 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "repeated_lines": "100 * n_dup_lines > 50 * n_lines",
    "letterless_words": "100 * n_letterless_words > 30 * n_words",
    "bullet_lines": "100 * n_bullet_lines > 90 * n_lines",
    "ellipsis_lines": "100 * n_ellipsis_lines > 30 * n_lines",
    "echoes": "100 * n_echoes > 30 * n_words",
}


def mask_of(*rules: str) -> int:
    return sum(1 << list(RULES).index(rule) for rule in rules)


@dataclass(frozen=True)
class Policy:
    """A named choice of rules: a text is kept if it fails none of them."""

    version: str
    mask: int


BASE = Policy("base", mask_of("short_text", "repeated_windows"))
POLICY = Policy("3", mask_of(*RULES))


def _line_counts(text: str) -> tuple[int, int, int, int]:
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    bullets = sum(line.lstrip(SPACES).startswith(BULLETS) for line in lines)
    ellipses = sum(line.rstrip(SPACES).endswith(ELLIPSES) for line in lines)
    return len(lines), len(lines) - len(set(lines)), bullets, ellipses


def _repeat_words(block: WordBlock) -> np.ndarray:
    """Words of each text that lie in a window found more than once in the text."""
    starts = block.window_starts(WINDOW)
    if not len(starts):
        return np.zeros(len(block.counts), np.int64)
    room = np.maximum(block.counts - WINDOW + 1, 0)
    text = np.repeat(np.arange(len(room)), room)
    names = mixed(block.spans(starts, WINDOW) + text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, where, counts = np.unique(names, return_inverse=True, return_counts=True)
    again = starts[counts[where] > 1]
    edge = np.bincount(again, minlength=len(block.ids) + 1) - np.bincount(again + WINDOW, minlength=len(block.ids) + 1)
    inside = np.concatenate(([0], np.cumsum(np.cumsum(edge)[:-1] > 0)))
    return inside[block.starts[1:]] - inside[block.starts[:-1]]


def _letterless(block: WordBlock) -> np.ndarray:
    """Words of each text without any letter."""
    first = dict(zip(block.ids.tolist(), block.words, strict=True))
    plain = np.zeros(len(first) + 1, bool)
    for number, word in first.items():
        plain[number] = not any(map(str.isalpha, word.decode("utf-8", "surrogatepass")))
    total = np.concatenate(([0], np.cumsum(plain[block.ids])))
    return total[block.starts[1:]] - total[block.starts[:-1]]


def _echoes(block: WordBlock) -> np.ndarray:
    """Words of each text that repeat the word before."""
    same = np.zeros(len(block.ids) + 1, np.int64)
    same[1:-1] = block.ids[1:] == block.ids[:-1]
    same[block.starts] = 0
    total = np.concatenate(([0], np.cumsum(same)))
    return total[block.starts[1:]] - total[block.starts[:-1]]


def _measure_rows(keep):
    def run(batches):
        for batch in batches:
            for part in pieces(batch):
                texts = [text or "" for text in part.column("text").to_pylist()]
                block = WordBlock(texts)
                lines = np.array([_line_counts(text) for text in texts], np.int64).reshape(-1, 4)
                chars = [len(text) - sum(map(text.count, SPACES)) for text in texts]
                symbols = [sum(map(text.count, SYMBOLS)) for text in texts]
                columns = (block.counts, chars, symbols, lines[:, 0], lines[:, 1], _repeat_words(block), _letterless(block), lines[:, 2], lines[:, 3], _echoes(block))
                measured = pa.StructArray.from_arrays([pa.array(column, pa.int64()) for column in columns], MEASURES)
                yield pa.RecordBatch.from_arrays([*map(part.column, keep), measured], [*keep, "measured"])

    return run


def with_ledger(docs: DataFrame, keep: list[str], name: str) -> DataFrame:
    """The columns ``keep`` of ``docs`` and the ledger of each text as the struct ``name``."""
    # numbered names, so that no column of docs can clash with another
    kept = [f"c{i}" for i in range(len(keep))]
    rows = docs.select(*[F.col(f"`{c}`").alias(k) for c, k in zip(keep, kept, strict=True)], F.col("text").cast("string").alias("text"))
    kinds = [f"{k} {docs.schema[c].dataType.simpleString()}" for c, k in zip(keep, kept, strict=True)]
    measured = rows.mapInArrow(_measure_rows(kept), ", ".join([*kinds, f"measured struct<{', '.join(f'{m}: long' for m in MEASURES)}>"]))
    found = measured.select(*kept, "measured.*")
    failed = F.lit(0).cast("long")
    for i, rule in enumerate(RULES.values()):
        failed = failed.bitwiseOR(F.when(F.expr(rule), 1 << i).otherwise(0).cast("long"))
    ledger = F.struct(*MEASURES, failed.alias("failed")).alias(name)
    return found.select(*[F.col(k).alias(c) for c, k in zip(keep, kept, strict=True)], ledger)


def quality_ledger(docs: DataFrame) -> DataFrame:
    """``doc_id``, the measurements, and ``failed``, the bits of the rules that failed."""
    return with_ledger(docs, ["doc_id"], "ledger").select(F.col("doc_id").cast("long").alias("doc_id"), "ledger.*")


def fails(policy: Policy, failed: str = "failed") -> Column:
    return F.col(failed).bitwiseAND(F.lit(policy.mask).cast("long")) != 0


def ablations(ledger: DataFrame, policy: Policy = POLICY) -> DataFrame:
    """For each rule of a policy: documents that fail it, that fail it alone, and that all rules keep."""
    bits = ledger.groupBy("failed").agg(F.count("*").alias("n"))
    bits = bits.select("n", F.col("failed").bitwiseAND(F.lit(policy.mask).cast("long")).alias("failed"))
    rules = [F.struct(F.lit(name).alias("rule"), F.lit(1 << i).cast("long").alias("bit")) for i, name in enumerate(RULES) if policy.mask >> i & 1]
    each = bits.select("n", "failed", F.explode(F.array(*rules)).alias("of")).select("n", "failed", "of.*")
    return each.groupBy("rule", "bit").agg(
        F.sum(F.when(F.col("failed").bitwiseAND(F.col("bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("failed") == F.col("bit"), F.col("n")).otherwise(0)).alias("n_failed_alone"),
        F.sum(F.when(F.col("failed") == 0, F.col("n")).otherwise(0)).alias("n_kept"),
    )


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = quality_ledger(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    base = fails(BASE)
    return ledger.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), (~base & ~fails(POLICY)).alias("kept"), "failed", F.lit(POLICY.version).alias("policy"),
    )


_BITS = " + ".join(f"CASE WHEN {rule} THEN {1 << i} ELSE 0 END" for i, rule in enumerate(RULES.values()))

OP9_SQL = rf"""
WITH cut AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), win AS (
  SELECT r, unnest(range(1, greatest(len(words) - 6, 1))) AS i, words FROM cut
), named AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, list_slice(words, i, i + 7)) AS n FROM win
), inside AS (
  SELECT r, count(DISTINCT w) AS n_repeat_words FROM (SELECT r, unnest(range(i, i + 8)) AS w FROM named WHERE n > 1) GROUP BY r
), measured AS (
  SELECT doc_id, len(words)::BIGINT AS n_words, length(list_reduce(list_prepend('', words), lambda a, b: a || b))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, len(lines)::BIGINT AS n_lines,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         len(list_filter(words, lambda w: NOT regexp_matches(w, '\p{{L}}')))::BIGINT AS n_letterless_words,
         len(list_filter(lines, lambda l: regexp_matches(l, '^[\x20\x09-\x0D]*[-*•‣]')))::BIGINT AS n_bullet_lines,
         len(list_filter(lines, lambda l: regexp_matches(l, '(\.\.\.|…)[\x20\x09-\x0D]*$')))::BIGINT AS n_ellipsis_lines,
         len(list_filter(words, lambda w, i: i > 1 AND w = words[i - 1]))::BIGINT AS n_echoes
  FROM cut LEFT JOIN inside USING (r)
), ledger AS (
  SELECT *, ({_BITS})::BIGINT AS failed FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (failed & {BASE.mask}) != 0 AS base_failed,
       (failed & {POLICY.mask}) = 0 AS kept, failed, '{POLICY.version}' AS policy
FROM ledger
"""
