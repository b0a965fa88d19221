"""Operator 11: hard negatives by exact integer scores from a residue number system.

1. *Residues.*  Integer vectors are taken modulo primes below 1024, as float32 between -510 and 510.
   Sixty-four products of such residues stay below 2**24, so a float32 matrix product is exact;
   longer vectors are multiplied 64 components at a time and reduced in between.
2. *Scores.*  Chinese remaindering in balanced mixed radix turns the remainders of a score into the
   signed score itself.  As many primes are taken as the largest norm of the table asks for.
3. *Selection.*  Anchors and rows are dealt into blocks by a hash of their content, and each pair of
   blocks is one group.  A first pass takes every anchor's best rows of its own label, the positives;
   a second one sorts an anchor's scores once and cuts the window of every positive out of them.
   What the groups return is ranked by windows that limit their groups before the shuffle.

No group is larger than two blocks, whatever labels, vectors or ids repeat.  Rows equal in id, label
and vector are one with a count, and count as often as they are there.

Defined cases: rows with a null id, a null label, a null vector, or a null or non-finite component
take no part; an empty vector scores 0; where lengths differ, missing components are 0; ties go to
the smaller id; a repeated anchor returns its rows once for each copy, and its other copies are
positives; an anchor without other rows of its label returns nothing, and so does a positive with a
negative score, as its window is empty; scores that could pass 5e17 raise an ArithmeticError;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from millrace.llm.blocks import ship
from millrace.llm.components import stored

ship(__name__)

PRIMES = (1021, 1019, 1013, 1009, 997, 991)
# 64 * 510**2 is below 2**24, up to which float32 holds every integer.
DEPTH = 64
ROW_BLOCK = 8192
ANCHOR_BLOCK = 4096
# Anchors whose scores with a block of rows are held at once.
STRIP = 256
COPIES = 1 << 16


def primes_for(largest: int) -> tuple[int, ...]:
    """The primes whose product holds every score from ``-largest`` to ``largest``."""
    for n in range(1, len(PRIMES) + 1):
        if math.prod(PRIMES[:n]) > 2 * largest:
            return PRIMES[:n]
    raise ArithmeticError(f"scores up to {largest} do not fit the residues' range")


def residues(vectors: np.ndarray, primes: tuple[int, ...]) -> list[np.ndarray]:
    """The vectors modulo every prime, around 0."""
    return [((vectors + p // 2) % p - p // 2).astype(np.float32) for p in primes]


def scores(left: list[np.ndarray], right: list[np.ndarray], primes: tuple[int, ...]) -> np.ndarray:
    """Exact inner products of all rows of ``left`` and ``right``, given as residues."""
    total, weight = None, 1
    for a, b, p in zip(left, right, primes, strict=True):
        rest = np.zeros((len(a), len(b)), np.int64)
        for at in range(0, a.shape[1], DEPTH):
            rest += (a[:, at : at + DEPTH] @ b[:, at : at + DEPTH].T).astype(np.int64)
        half = p // 2
        if total is None:
            total = (rest + half) % p - half
        else:
            digit = (rest - total) % p * pow(weight, -1, p)
            total += ((digit + half) % p - half) * weight
        weight *= p
    return total


class _Side:
    """One block of a group: ids, labels, counts and residues, in the order of ids."""

    def __init__(self, table: pa.Table, width: int, primes: tuple[int, ...]):
        table = table.sort_by([("vec_id", "ascending"), ("row", "ascending")])
        self.table = table
        self.id, self.row, self.label, self.n = (table[c].to_numpy() for c in ("vec_id", "row", "label", "n"))
        flat = table["vector"].combine_chunks()
        sizes = flat.value_lengths().to_numpy(zero_copy_only=False)
        vectors = np.zeros((len(table), width), np.int64)
        ends = np.cumsum(sizes)
        across = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes)
        vectors[np.repeat(np.arange(len(table)), sizes), across] = flat.flatten().to_numpy()
        self.residues = residues(vectors, primes)


def _strips(rows: pa.Table, anchors: pa.Table, primes: tuple[int, ...]):
    """For every anchor its number and its scores with the block's rows, and both sides."""
    width = max([0, *(max((len(x) for x in t["vector"]), default=0) for t in (rows, anchors))])
    there, asked = _Side(rows, width, primes), _Side(anchors, width, primes)
    for at in range(0, len(anchors), STRIP):
        block = scores([r[at : at + STRIP] for r in asked.residues], there.residues, primes)
        for i, found in enumerate(block, at):
            yield i, found, asked, there


def _positives(k: int, primes: tuple[int, ...]):
    schema = pa.schema([("anchor_id", pa.int64()), ("anchor_row", pa.int64()), ("other_id", pa.int64()), ("other_row", pa.int64()), ("score", pa.int64())])

    def run(key, rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out = []
        if len(rows) and len(anchors):
            for i, found, asked, there in _strips(rows, anchors, primes):
                own = (there.id == asked.id[i]) & (there.row == asked.row[i])
                left = np.where(own, there.n - 1, there.n)
                alike = np.flatnonzero((there.label == asked.label[i]) & (left > 0))
                alike = alike[np.argsort(-found[alike], kind="stable")][:k]
                alike = np.repeat(alike, np.minimum(left[alike], k))[:k]
                out.append((np.full(len(alike), asked.id[i]), np.full(len(alike), asked.row[i]), there.id[alike], there.row[alike], found[alike]))
        return pa.table([np.concatenate(c) for c in zip(*out, strict=True)], schema=schema) if out else schema.empty_table()

    return run


def _negatives(k: int, low: int, high: int, primes: tuple[int, ...]):
    schema = pa.schema([
        ("anchor_id", pa.int64()), ("anchor_row", pa.int64()), ("place", pa.int32()), ("positive_id", pa.int64()),
        ("positive_score", pa.int64()), ("other_id", pa.int64()), ("other_row", pa.int64()), ("score", pa.int64()), ("copies", pa.int64()),
    ])

    def run(key, rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out = []
        if len(rows) and len(anchors):
            for i, found, asked, there in _strips(rows, anchors, primes):
                if i == 0:
                    wanted = asked.table["positives"].to_pylist()
                others = np.flatnonzero(there.label != asked.label[i])
                others = others[np.argsort(-found[others], kind="stable")]
                falling = -found[others]
                for p in wanted[i]:
                    # Python integers: the percentages of a score need not fit 64 bits
                    least, most = -(-low * p["score"] // 100), high * p["score"] // 100
                    a, b = np.searchsorted(falling, -most, "left"), np.searchsorted(falling, -least, "right")
                    taken = others[a : min(b, a + k)]
                    taken = np.repeat(taken, np.minimum(there.n[taken], k))[:k]
                    m = len(taken)
                    out.append((
                        np.full(m, asked.id[i]), np.full(m, asked.row[i]), np.full(m, p["place"], np.int32), np.full(m, p["other_id"]),
                        np.full(m, p["score"]), there.id[taken], there.row[taken], found[taken], np.full(m, asked.n[i]),
                    ))
        return pa.table([np.concatenate(c) for c in zip(*out, strict=True)], schema=schema) if out else schema.empty_table()

    return run


def _met(rows: DataFrame, anchors: DataFrame, row_block: int, anchor_block: int):
    """Both sides, grouped so that every block of anchors meets every block of rows once."""
    n_rows, n_anchors = (-(-max(1, df.count()) // size) for df, size in ((rows, row_block), (anchors, anchor_block)))
    of_row = F.pmod("row", F.lit(n_rows)).alias("row_part")
    of_anchor = F.pmod(F.xxhash64("row", "vec_id"), F.lit(n_anchors)).alias("anchor_part")
    part = lambda n, name: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))).alias(name)
    left = rows.select("*", of_row, part(n_anchors, "anchor_part"))
    right = anchors.select("*", of_anchor, part(n_rows, "row_part"))
    return left.groupBy("row_part", "anchor_part").cogroup(right.groupBy("row_part", "anchor_part"))


def _first(df: DataFrame, k: int, name: str, *by: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "other_id", "other_row")
    return df.withColumn(name, F.row_number().over(order)).filter(F.col(name) <= k)


def integers(vector: Column, scale: int = 256) -> Column:
    """Every component times ``scale``, rounded down, as a long."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return vector.isNotNull() & ~F.exists(vector, lambda x: odd(x.cast("double")))


def mine_hard_negatives(
    vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, row_block: int = ROW_BLOCK, anchor_block: int = ANCHOR_BLOCK
) -> DataFrame:
    """The first ``negatives`` rows of another label whose score lies in a positive's window.

    ``vectors`` has ``vec_id`` long, ``label`` and ``vector``, an array of longs; ``is_anchor`` is a
    condition on them.  A window goes from ``low`` to ``high`` percent of the positive's score.
    Returns ``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score`` and
    ``negative_score`` for each of an anchor's first ``positives`` rows of its label.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "vector")
    rows = rows.filter("vec_id is not null and label is not null and vector is not null")
    rows = rows.groupBy("vec_id", "label", "vector").agg(F.count("*").alias("n"))
    rows = stored(rows.withColumn("row", F.xxhash64("vec_id", "label", "vector")), "vectors")
    norm = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    primes = primes_for(math.ceil((rows.agg(F.max(norm)).first()[0] or 0) * 1.000001))
    anchors = rows.filter(is_anchor)
    best = _met(rows, anchors, row_block, anchor_block).applyInArrow(
        _positives(positives, primes), "anchor_id long, anchor_row long, other_id long, other_row long, score long"
    )
    best = _first(best, positives, "place", "anchor_id", "anchor_row").filter("score >= 0")
    chosen = best.groupBy("anchor_id", "anchor_row").agg(F.collect_list(F.struct("place", "other_id", "score")).alias("positives"))
    asked = anchors.join(chosen, (F.col("vec_id") == F.col("anchor_id")) & (F.col("row") == F.col("anchor_row"))).drop("anchor_id", "anchor_row")
    found = _met(rows, stored(asked, "anchors"), row_block, anchor_block).applyInArrow(
        _negatives(negatives, low, high, primes),
        "anchor_id long, anchor_row long, place int, positive_id long, positive_score long, other_id long, other_row long, score long, copies long",
    )
    found = _first(found, negatives, "rank", "anchor_id", "anchor_row", "place")
    # copies of an anchor are made in two steps, so that no array grows with their number
    found = found.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(copies - 1) div {COPIES}"))).alias("part"))
    again = F.sequence(F.lit(1).cast("long"), F.least(F.col("copies") - F.col("part") * COPIES, F.lit(COPIES)))
    found = found.select("*", F.explode(again))
    return found.select("anchor_id", "positive_id", "rank", F.col("other_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth row, with every seventh row's label moved on by one."""
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").filter(usable(F.col("embedding")))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table.select("vec_id", moved.alias("label"), integers(F.col("embedding")).alias("vector"))
    return mine_hard_negatives(vectors, F.col("vec_id") % 100 == 0)


OP11_SQL = r"""
WITH vec AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), score AS (
  SELECT a.r AS ar, b.r AS br, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS alike, list_inner_product(a.v, b.v)::BIGINT AS s
  FROM vec a JOIN vec b ON a.r <> b.r WHERE a.vec_id % 100 = 0
), positive AS (
  SELECT ar, br, anchor_id, vec_id AS positive_id, s AS positive_score FROM score WHERE alike
  QUALIFY row_number() OVER (PARTITION BY ar ORDER BY s DESC, vec_id) <= 5
)
SELECT p.anchor_id, positive_id, (row_number() OVER (PARTITION BY p.ar, p.br ORDER BY s DESC, vec_id))::INTEGER AS rank,
       vec_id AS negative_id, positive_score, s AS negative_score
FROM positive p JOIN score n ON n.ar = p.ar AND NOT alike AND 100 * s BETWEEN 30 * positive_score AND 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.ar, p.br ORDER BY s DESC, vec_id) <= 10
"""
