"""Operator 7: toxicity by gradient-boosted trees over dense features, with isotonic calibration.

Three disjoint parts of the labelled training rows are used: one for a lexicon (words and word
beginnings that toxic texts hold far more often, with log-odds weights), one for the trees, one
for the calibration.  A part never sees what another was fitted on, so rare words of the lexicon
do not pass for sure signs.  Features of a text: lexicon densities, the same near words of the
second person, capitals, punctuation, and rates of obfuscated words, with the lexicon hits that
appear once obfuscation is undone.

Training is on at most about ``max_rows`` labelled rows, chosen by a hash of ``doc_id``, equal
texts counted once.  That bound and the one on the lexicon (``max_lexicon`` entries) are the only
things that come to the driver or are broadcast.  Scoring reads each text once and shuffles nothing.

Defined cases: null and empty texts have zero in every feature and get that score; repeated rows
get a row each; a null ``doc_id`` has no label and counts as held out; a null label is left out;
without training rows of both kinds every score is the share of toxic ones (0 without any); an
empty table gives no rows; other columns are ignored and never reach the model.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.llm.blocks import WordBlock, pieces, ship
from millrace.llm.components import stored

ship(__name__)

MAX_ROWS = 24_000
MAX_LEXICON = 2048
FOLDS = 5
BEGINNINGS = (4, 5, 6)
LEAST_WEIGHT = 2.0
NEAR = 5
MEMO = 200_000

SECOND_PERSON = frozenset(
    "you your yours yourself u ur tu te toi ton ta tes vous votre vos du dich dir dein deine deinen ihr euch euer "
    "usted ustedes ti tuyo tus vosotros os su".split()
)
LEET = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "*": None, ".": None, "_": None, "-": None})
EDGES = ".,;:!?\"'()[]{}<>«»“”„…-_*"
MIXED = re.compile(r"[^\W\d_][\d@$*!_.\-]+[^\W\d_]")
LONG_RUN = re.compile(r"([^\W\d_])\1\1")

FEATURES = (
    "lexicon_sum", "lexicon_rate", "lexicon_most", "second_person_rate", "lexicon_near_second_person",
    "capital_letters", "capital_words", "exclamations", "questions", "punctuation",
    "obfuscated_rate", "undone_lexicon_sum", "long_runs",
)


def units(word: str) -> tuple[str, ...]:
    """Lexicon entries that a lower-case word may match: itself and its beginnings."""
    return (word, *(word[:n] + "~" for n in BEGINNINGS if len(word) > n))


def _unit_rows(batches):
    """Per batch, how many toxic and other texts hold each unit."""
    for batch in batches:
        toxic, other = Counter(), Counter()
        for text, label in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
            words = {w.strip(EDGES) for w in set((text or "").lower().split())}
            (toxic if label else other).update({u for w in words if w for u in units(w)})
        names = list(toxic.keys() | other.keys())
        yield pa.RecordBatch.from_pydict({
            "unit": pa.array(names, pa.string()),
            "n_toxic": pa.array([toxic[u] for u in names], pa.int64()),
            "n_other": pa.array([other[u] for u in names], pa.int64()),
        })


class _WordMarks:
    """Per distinct word: lexicon weight, second person, capitals, obfuscation, undone weight, runs."""

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon, self.memo = lexicon, {}

    def weight(self, word: str) -> float:
        return max((self.lexicon.get(u, 0.0) for u in units(word)), default=0.0) if word else 0.0

    def of(self, raw: bytes) -> tuple[float, ...]:
        found = self.memo.get(raw)
        if found is None:
            if len(self.memo) > MEMO:
                self.memo.clear()
            word = raw.decode("utf-8", "surrogatepass")
            bare = word.strip(EDGES)
            low = bare.lower()
            weight = self.weight(low)
            mixed = bool(MIXED.search(low))
            undone = self.weight(low.translate(LEET)) if mixed else 0.0
            run = bool(LONG_RUN.search(low))
            if run and not weight:
                undone = max(undone, self.weight(LONG_RUN.sub(r"\1", low)))
            capital = len(bare) > 2 and bare.isupper()
            found = self.memo[raw] = (weight, low in SECOND_PERSON, capital, mixed, undone, run)
        return found


def _features(texts, marks: _WordMarks) -> np.ndarray:
    block = WordBlock(texts)
    n = len(texts)
    out = np.zeros((n, len(FEATURES)))
    chars = np.maximum([len(t or "") for t in texts], 1)
    for column, signs in ((7, "!"), (8, "?"), (9, ".,;:!?\"'()-")):
        out[:, column] = [sum(map((t or "").count, signs)) for t in texts] / chars
    out[:, 5] = [sum(map(str.isupper, t or "")) for t in texts] / chars
    if not len(block.ids):
        return out
    table = np.array([marks.of(word) for word in dict.fromkeys(block.words)], float)[block.ids]
    sums = np.vstack([np.zeros(table.shape[1]), np.cumsum(table, axis=0)])
    first, last = block.starts[:-1], block.starts[1:]
    words = np.maximum(block.counts, 1)
    weight = table[:, 0]
    hits = np.concatenate(([0], np.cumsum(weight > 0)))
    text = np.repeat(np.arange(n), block.counts)
    at = np.arange(len(text))
    near = sums[np.minimum(at + NEAR + 1, last[text]), 1] - sums[np.maximum(at - NEAR, first[text]), 1] > 0
    near = np.concatenate(([0], np.cumsum(near & (weight > 0))))
    total = sums[last] - sums[first]
    out[:, 0] = total[:, 0]
    out[:, 1] = (hits[last] - hits[first]) / words
    some = block.counts > 0
    out[some, 2] = np.maximum.reduceat(weight, first[some])
    out[:, 3] = total[:, 1] / words
    out[:, 4] = near[last] - near[first]
    out[:, 6] = total[:, 2] / words
    out[:, 10] = total[:, 3] / words
    out[:, 11] = total[:, 4]
    out[:, 12] = total[:, 5] / words
    return out


def _feature_rows(lexicon, keep):
    def run(batches):
        marks = _WordMarks(lexicon.value)
        for batch in batches:
            for part in pieces(batch):
                found = _features(part.column("text").to_pylist(), marks)
                ends = pa.array(np.arange(len(found) + 1, dtype=np.int32) * len(FEATURES))
                rows = pa.ListArray.from_arrays(ends, pa.array(found.ravel()))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), rows], [*keep, "features"])

    return run


@dataclass
class ToxicityModel:
    """The fitted parts; ``trees`` and ``steps`` are None if the labels were of one kind."""

    lexicon: dict[str, float]
    prior: float
    trees: GBTClassificationModel | None = None
    steps: IsotonicRegressionModel | None = None


def held_out() -> Column:
    """Rows whose labels are never learned from."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def _dense(rows: DataFrame, lexicon: dict[str, float], keep: str) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(lexicon)
    names = [c.split()[0] for c in keep.split(",")]
    found = rows.select(*names, "text").mapInArrow(_feature_rows(shared, names), f"{keep}, features array<double>")
    return found.withColumn("features", array_to_vector("features"))


def _raw_score(scored: DataFrame) -> DataFrame:
    return scored.withColumn("raw", F.get(vector_to_array("probability"), F.lit(1)))


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, max_lexicon: int = MAX_LEXICON) -> ToxicityModel:
    """Learn from the labelled rows that are not held out."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.filter(~held_out() & F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n_known = known.count()
    grain = 1 << 30
    share = min(1.0, max_rows / max(n_known, 1))
    chosen = known.filter(F.pmod(F.xxhash64(F.lit("row"), F.col("doc_id")), F.lit(grain)) < int(share * grain))
    # about max_rows pairs of numbers
    chosen = stored(chosen.withColumn("part", F.pmod(F.xxhash64(F.lit("part"), F.col("doc_id")), F.lit(100))), "labels")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = texts.join(F.broadcast(chosen), "doc_id").withColumn("name", F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    rows = stored(rows.dropDuplicates(["name"]).select("text", "toxic", "part"), "training")
    sizes = {(r.use, r.toxic): r.n for r in rows.groupBy(F.expr("part >= 45").alias("use"), "toxic").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_other = (sum(sizes.get((use, label), 0) for use in (False, True)) for label in (1, 0))
    prior = n_toxic / max(n_toxic + n_other, 1)
    least = min((sizes.get((use, label), 0) for use in (False, True) for label in (0, 1)))
    if not least:
        return ToxicityModel({}, prior)

    counts = rows.filter("part < 45").mapInArrow(_unit_rows, "unit string, n_toxic long, n_other long")
    counts = counts.groupBy("unit").agg(F.sum("n_toxic").alias("n_toxic"), F.sum("n_other").alias("n_other"))
    offset = math.log(sizes[False, 0] + 1) - math.log(sizes[False, 1] + 1)
    weight = F.log(F.col("n_toxic") + 0.5) - F.log(F.col("n_other") + 0.5) + F.lit(offset)
    counts = counts.filter("n_toxic >= 3").withColumn("weight", weight).filter(F.col("weight") >= LEAST_WEIGHT)
    top = counts.orderBy(F.desc(F.col("weight") * F.log1p("n_toxic")), "unit").limit(max_lexicon)
    lexicon = {r.unit: r.weight for r in top.collect()}

    dense = stored(_dense(rows.filter("part >= 45"), lexicon, "toxic int, part long").withColumn("label", F.col("toxic").cast("double")), "features")
    dense = dense.coalesce(8)
    trees_rows, steps_rows = dense.filter("part < 80"), dense.filter("part >= 80")
    kinds = trees_rows.select("toxic").distinct().count(), steps_rows.select("toxic").distinct().count()
    if kinds[0] < 2:
        trees_rows = dense
    trees = GBTClassifier(maxIter=20, maxDepth=4, stepSize=0.2, seed=7).fit(trees_rows)
    steps_rows = _raw_score(trees.transform(steps_rows if kinds[1] == 2 else dense)).select("raw", "label")
    steps = IsotonicRegression(featuresCol="raw", labelCol="label", predictionCol="step").fit(steps_rows)
    return ToxicityModel(lexicon, prior, trees, steps)


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``doc_id`` and ``score`` of every text.

    The calibrated score has steps; a hundredth of the trees' own score keeps their order within one.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if model.trees is None:
        return rows.select("doc_id", F.lit(model.prior).alias("score"))
    raw = _raw_score(model.trees.transform(_dense(rows, model.lexicon, "doc_id long"))).select("doc_id", "raw")
    calibrated = model.steps.transform(raw)
    return calibrated.select("doc_id", (F.col("step") * 0.99 + F.col("raw") * 0.01).alias("score"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = score(docs, model)
    return scored.select("doc_id", held_out().alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
