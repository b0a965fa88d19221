"""Joins of points in time with the intervals that hold them.

An interval goes to a grid whose bins are at least as long as it is, so it lies in two
bins at most, however long; a point looks into one bin of each grid that is in use.
That is an equi-join on key, grid and bin with the exact bounds behind it, which Spark
can split and sort; the bins also cut a key with very many rows along time.  Grids are
``FAN`` times coarser from one to the next, so there are only a few.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from millrace.operators.asof import asof_join
from millrace.operators.skew import DEFAULT_POLICY, SkewPolicy

FINEST = 3_600_000_000  # microseconds
FAN = 16
# FINEST * FAN**13 is longer than any time span of 64 bits.
GRIDS = 14
OPEN = GRIDS


def _grid(length: Column, finest: int) -> Column:
    """Number of the finest grid whose bins are not shorter than ``length``."""
    grid = F.when(length <= finest, 0)
    for n in range(1, GRIDS):
        grid = grid.when(length <= finest * FAN**n, n) if finest * FAN**n < 1 << 63 else grid
    return grid.otherwise(OPEN)


def _bin(micros: Column, grid: Column, finest: int) -> Column:
    """Bin of a time; the last grid has only one."""
    out = F.when(grid == OPEN, F.lit(0).cast("long"))
    for n in range(GRIDS):
        if finest * FAN**n < 1 << 63:
            out = out.when(grid == n, _floor(micros, finest * FAN**n))
    return out


def _floor(micros: Column, width: int) -> Column:
    """Floor division of longs: the dividend is a multiple of the divisor, so no double rounds it."""
    width = F.lit(width).cast("long")
    return F.call_function("div", micros - F.pmod(micros, width), width)


def interval_join(
    points: DataFrame,
    intervals: DataFrame,
    on: str | Sequence[str],
    time: str,
    start: str,
    end: str,
    how: str = "inner",
    prefix: str = "",
    finest: int = FINEST,
) -> DataFrame:
    """Every row of ``points`` with every row of ``intervals`` whose ``start <= time < end``.

    Rows match on the columns ``on`` too, if any; null keys match nothing.  A null
    ``end`` is open; an interval without a start, or that does not end after it, holds
    no point, and a point without a time lies in none.  Intervals may overlap, so a
    point can come many times.  ``how="left"`` keeps points that lie in none, with nulls.  ``finest``
    is the bin length of the finest grid in microseconds and changes the plan only.

    The columns of ``intervals`` but ``on`` follow, named with ``prefix``.
    """
    on = [on] if isinstance(on, str) else list(on)
    brought = [c for c in intervals.columns if c not in on]
    taken = {c.lower() for c in points.columns}
    if clash := [prefix + c for c in brought if (prefix + c).lower() in taken]:
        raise ValueError(f"columns on both sides: {clash}")
    if how not in ("inner", "left"):
        raise ValueError(f"how={how!r}: inner or left")

    micros = lambda c: F.unix_micros(F.col(f"`{c}`").cast("timestamp"))
    length = micros(end) - micros(start)
    grid = F.when(F.col(f"`{end}`").isNull(), OPEN).otherwise(_grid(length, finest))
    there = intervals.filter(micros(start).isNotNull() & (F.col(f"`{end}`").isNull() | (length > 0)))
    keys = [F.col(c).alias(f"_key{i}") for i, c in enumerate(on)]
    there = there.select(*keys, F.struct(*[F.col(c).alias(prefix + c) for c in brought]).alias("_interval"), micros(start).alias("_from"), micros(end).alias("_to"), grid.alias("_grid"))
    first, last = (_bin(F.col(c), F.col("_grid"), finest) for c in ("_from", "_to"))
    last = F.when(F.col("_grid") == OPEN, first).otherwise(_bin(F.col("_to") - 1, F.col("_grid"), finest))
    placed = there.withColumn("_bin", F.explode(F.sequence(first, last)))

    grids = [r[0] for r in there.select("_grid").distinct().collect()]  # 15 at most
    names = [f"_key{i}" for i in range(len(on))]
    asked = points.select(F.struct(*points.columns).alias("_point"), *keys, micros(time).alias("_time")).filter("_time is not null")
    asked = asked.withColumn("_grid", F.explode(F.array(*map(F.lit, grids)).cast("array<int>")))
    asked = asked.withColumn("_bin", _bin(F.col("_time"), F.col("_grid"), finest))
    held = asked.join(placed, [*names, "_grid", "_bin"]).filter("_from <= _time and (_to is null or _time < _to)")
    columns = [*[F.col(f"_point.`{c}`") for c in points.columns], *[F.col(f"_interval.`{prefix + c}`") for c in brought]]
    found = held.select(*columns)
    if how == "inner":
        return found
    # whether a point lies in an interval depends on its key and time alone
    hit = held.select(*names, "_time").distinct()
    same = micros(time) == F.col("_time")
    for name, c in zip(names, on, strict=True):
        same = same & (F.col(f"`{c}`") == F.col(name))
    missing = [F.lit(None).cast(intervals.schema[c].dataType).alias(prefix + c) for c in brought]
    return found.unionAll(points.join(hit, same, "left_anti").select(*points.columns, *missing))


def version_at(
    points: DataFrame,
    versions: DataFrame,
    on: str | Sequence[str],
    time: str,
    start: str = "valid_from",
    end: str = "valid_to",
    prefix: str = "",
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Every point with the version that is valid at its time, if there is one.

    For versions that do not overlap, such as a type-2 history: then the last one that
    began is the only one that can hold the point, and an as-of join finds it without grids.
    """
    found = asof_join(points, versions, on, time, start, prefix=prefix, policy=policy)
    on = [on] if isinstance(on, str) else list(on)
    until = F.col(f"`{prefix}{end}`")
    valid = F.col(f"`{prefix}{start}`").isNotNull() & (until.isNull() | (F.col(f"`{time}`") < until))
    brought = [prefix + c for c in versions.columns if c not in on]
    return found.select(*points.columns, *[F.when(valid, F.col(f"`{c}`")).alias(c) for c in brought])
