"""Documents to training tokens: quality rules, line dedup, near-dedup, decontamination, BPE.

Every stage works on what the one before has kept, written and read again.  A stage that drops
documents leaves the others as they are; all but the last return the columns they are given.
Documents are matched by the content of id and text, not by id alone, so null and repeated ids
cost none of them.
"""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.llm.bpe import digests, word_bpe_path
from millrace.llm.components import stored
from millrace.llm.ledger import BASE, POLICY, fails, with_ledger
from millrace.llm.lineruns import drop_repeated_lines
from millrace.llm.native import fresh, row_key
from millrace.llm.setsketch import near_duplicates
from millrace.llm.winnowing import find_benchmark_spans


def _columns(docs: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in docs.columns]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that fail no rule of the base and of the current policy."""
    name = fresh(docs, "_quality")
    ledger = with_ledger(docs, docs.columns, name)
    return ledger.filter(~fails(BASE, f"{name}.failed") & ~fails(POLICY, f"{name}.failed")).select(*_columns(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without later copies of line runs; one that loses all its lines goes."""
    count, removed, runs = (fresh(docs, name) for name in ("_n_lines", "_removed", "_runs"))
    found = drop_repeated_lines(docs, count=count, removed=removed, runs=runs)
    return found.filter((F.size(removed) == 0) | (F.size(removed) < F.col(count))).select(*_columns(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the smallest id; those without words are in no group and stay."""
    found = near_duplicates(docs).filter("group is not null")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row_key")).alias("first")
    key = fresh(docs, "_key")
    kept = found.groupBy("group").agg(first).select(F.col("first.row_key").alias(key))
    worded = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    # the key holds all of id and text, so rows that share it are repeats
    grouped = docs.filter(worded).withColumn(key, row_key("doc_id", "text")).join(kept, key, "left_semi").dropDuplicates([key])
    return grouped.select(*_columns(docs)).unionByName(docs.filter(~worded))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no window of a benchmark item."""
    _, hits, _ = find_benchmark_spans(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    key = fresh(docs, "_key")
    hit = hits.select(F.col("key").alias(key)).distinct()
    return docs.withColumn(key, row_key("doc_id", "text")).join(hit, key, "left_anti").select(*_columns(docs))


def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts, and digests of the ids and of the text they decode to."""
    return digests(docs, word_bpe_path())


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("bpe_tokens", bpe_tokens),
]

# Near-duplicate components and BPE merges are beyond SQL; the tests use a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
