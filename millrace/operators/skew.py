"""Keeping one hot key from becoming one slow task.

Hash partitioning sends all rows of a key to one task.  For joins adaptive
execution splits such a partition by itself.  For windows it cannot, so where a
key may hold a large share of a table, a bounded sample of the key column finds
the heavy keys, and those are cut along the ordering column.  For writing without
adaptive execution they get a salt.  The sample steers the plan, never the result:
every row is still processed, and a heavy key the sample misses is merely slow.

Small inputs skip the sample, so they get Catalyst's ordinary plan.
"""

from collections import Counter
from dataclasses import dataclass
from math import isqrt

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T


@dataclass(frozen=True)
class SkewPolicy:
    """When to look for heavy keys, and how finely to split them.

    The sample is thinned so that a cell of ``cell_rows`` rows of a key gives
    ``min_hits`` hits.  A key with more hits than that is heavy and is split into
    cells of so many hits.  On inputs that could hold more than ``most_cells`` such
    cells, at ``row_bytes`` a row at least, cells are larger: that bounds
    everything collected or broadcast here.
    """

    min_bytes: int = 256 << 20
    min_hits: int = 100
    cell_rows: int = 1_000_000
    most_cells: int = 40_000
    row_bytes: int = 16


DEFAULT_POLICY = SkewPolicy()

# Catalyst's estimate for an input it knows nothing of is near the largest long.
UNKNOWN_BYTES = 1 << 60


def input_bytes(df: DataFrame) -> int:
    """Size of the files behind a result."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(
        int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())
    )


def _sample(df: DataFrame, policy: SkewPolicy) -> DataFrame | None:
    """A sample to find heavy keys in, or None if ``df`` is small.

    Runs nothing, but for inputs that Spark does not know the size of, such as
    tables from RDDs: those it counts.
    """
    size = input_bytes(df)
    if size < policy.min_bytes:
        return None
    most_rows = size // policy.row_bytes if size < UNKNOWN_BYTES else df.count()
    cell = max(policy.cell_rows, most_rows // policy.most_cells)
    fraction = policy.min_hits / cell
    return df.sample(fraction, seed=11) if fraction < 1 else df


def heavy_keys(df: DataFrame, key: str, policy: SkewPolicy = DEFAULT_POLICY):
    """``(key, cells)`` of each heavy key, null included; at most a few 10,000."""
    sample = _sample(df.select(F.col(key).alias("key")), policy)
    if sample is None:
        return []
    counts = sample.groupBy("key").agg(F.count(F.lit(1)).alias("hits"))
    return [
        (r["key"], -(-r["hits"] // policy.min_hits))
        for r in counts.filter(F.col("hits") > policy.min_hits).collect()
    ]


def _cells_table(df: DataFrame, key: str, heavy) -> DataFrame:
    schema = T.StructType(
        [
            T.StructField("_heavy_key", df.schema[key].dataType),
            T.StructField("_cells", T.IntegerType()),
        ]
    )
    return F.broadcast(df.sparkSession.createDataFrame(heavy, schema))


def add_salt(df: DataFrame, key: str, heavy, name: str) -> DataFrame:
    """Add ``name``: 0 for ordinary keys, a cell number for rows of heavy ones.

    The salt depends on the row and the partition it lies in.  So a recomputed
    task assigns it again, and copies of one row still spread.
    """
    hashable = [
        f.name
        for f in df.schema.fields
        if not isinstance(f.dataType, (T.MapType, T.VariantType))
    ]
    spread = F.pmod(F.xxhash64(F.spark_partition_id(), *hashable), F.col("_cells"))
    return (
        df.join(
            _cells_table(df, key, heavy),
            F.col(key).eqNullSafe(F.col("_heavy_key")),
            "left",
        )
        .withColumn(
            name,
            F.when(F.col("_cells").isNotNull(), spread.cast("int")).otherwise(F.lit(0)),
        )
        .drop("_heavy_key", "_cells")
    )


@dataclass(frozen=True)
class Slices:
    """Heavy keys cut along the order column; all of it bounded by the policy.

    ``cuts`` has one row per heavy key; ``instants`` the (key, micros) pairs that
    by themselves fill more than a cell.
    """

    cuts: DataFrame
    instants: DataFrame | None
    null_key: bool = False


def heavy_slices(
    df: DataFrame, key: str, ts: str, policy: SkewPolicy = DEFAULT_POLICY
) -> Slices | None:
    """Cut points at every full cell of each heavy key, null included, from one sample.

    This is the one job that runs while a plan is built.  Ranking the sample by key
    is one task for each key, of ``most_cells * min_hits`` rows at most.
    """
    sample = _sample(
        df.select(F.col(key).alias("key"), F.unix_micros(ts).alias("_micros")), policy
    )
    if sample is None:
        return None
    by_key = Window.partitionBy("key").orderBy("_micros")
    cuts = (
        sample.filter("_micros is not null")
        .withColumn("position", F.row_number().over(by_key))
        .filter(F.col("position") % policy.min_hits == 0)
        .select("key", "_micros")
        .collect()
    )
    if not cuts:
        return None
    points = {}
    for cut in cuts:
        points.setdefault(cut["key"], Counter())[cut["_micros"]] += 1
    instants = []
    rows = []
    for value, micros in points.items():
        unique = sorted(micros)
        instants += [(value, m) for m in unique if micros[m] > 1]
        step = isqrt(len(unique)) + 1
        blocks = [unique[i : i + step] for i in range(0, len(unique), step)]
        rows.append((value, [b[0] for b in blocks], blocks))

    spark = df.sparkSession
    key_field = T.StructField("_heavy_key", df.schema[key].dataType)
    longs = T.ArrayType(T.LongType())
    cut_schema = T.StructType(
        [
            key_field,
            T.StructField("_starts", longs),
            T.StructField("_blocks", T.ArrayType(longs)),
        ]
    )
    instant_schema = T.StructType([key_field, T.StructField("_micros", T.LongType())])
    return Slices(
        spark.createDataFrame(rows, cut_schema),
        spark.createDataFrame(instants, instant_schema) if instants else None,
        None in points,
    )


def add_slice(df: DataFrame, key: str, ts: str, cuts: DataFrame) -> DataFrame:
    """Add ``_slice``: 0 for ordinary keys, rising with ``ts`` for heavy ones.

    Two short scans, first over the block starts and then inside one block, find
    the slice among n cut points in about 2 * sqrt(n) comparisons.
    """
    micros = F.unix_micros(ts)
    block = F.size(F.filter("_starts", lambda s: s <= micros))
    inside = F.size(
        F.filter(
            F.coalesce(F.get("_blocks", block - 1), F.array().cast("array<bigint>")),
            lambda s: s <= micros,
        )
    )
    number = block.cast("long") * F.lit(1 << 20) + inside + 1
    return (
        df.join(F.broadcast(cuts), F.col(key).eqNullSafe(F.col("_heavy_key")), "left")
        .withColumn(
            "_slice",
            F.when(F.col("_starts").isNotNull(), number).otherwise(F.lit(0)),
        )
        .drop("_heavy_key", "_starts", "_blocks")
    )


def join_columns(df: DataFrame, key: str, null_key: bool) -> tuple[DataFrame, list[str]]:
    """``df`` and columns that group like ``key`` and match in a plain join.

    Where null is a heavy key, two helper columns stand for it, so that windows and
    joins agree on one partitioning.
    """
    if not null_key:
        return df, [key]
    filler = F.lit("0").try_cast(df.schema[key].dataType)
    helpers = {"_key": F.coalesce(F.col(key), filler), "_key_is_null": F.col(key).isNull()}
    return df.withColumns(helpers), list(helpers)


def beside(
    df: DataFrame,
    step: int,
    value: Column,
    edge: Column,
    keys: list[str],
    order: list[str],
    name: str,
) -> DataFrame:
    """Add ``value`` of the key's next (1) or previous (-1) row as ``name``.

    ``value`` must not be null.  If ``df`` has a ``_slice`` column, the window runs
    inside each slice, and the rows at its end look up the neighbouring slice in a
    table with one row per slice.  ``edge`` aggregates a slice to the value of the
    row its neighbour sees: the first row for 1, the last for -1.  That table has no
    hint: its rows may be wide, and ``df`` is partitioned for the join already.
    """
    shift = F.lead if step > 0 else F.lag
    sliced = "_slice" in df.columns
    groups = [*keys, "_slice"] if sliced else keys
    within = Window.partitionBy(*groups).orderBy(*order)
    out = df.withColumn(name, shift(value).over(within))
    if not sliced:
        return out

    along = Window.partitionBy(*keys).orderBy("_slice")
    edges = (
        df.filter("_slice > 0")
        .groupBy(*groups)
        .agg(edge.alias("_edge"))
        .withColumn("_edge", shift("_edge").over(along))
        .filter("_edge is not null")
    )
    return (
        out.join(edges, groups, "left")
        .withColumn(name, F.coalesce(name, "_edge"))
        .drop("_edge")
    )
