"""Sessions and rolling frames over events.

Both are windows along time within a key.  A key that holds a large share of the rows is
cut along time (``skew``): sessions are stitched over the edges of slices, and
rolling sums are differences of running totals, which an as-of join looks up, so that no
frame is copied to the slice it reaches into.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.operators import skew
from millrace.operators.asof import asof_join
from millrace.operators.skew import SkewPolicy

# Events are narrow and compress well, and each passes several windows: a key is cut earlier, and finer.
EVENT_POLICY = SkewPolicy(min_bytes=16 << 20, cell_rows=250_000)


def _cut(events: DataFrame, key: str, time: str, policy: SkewPolicy) -> tuple[DataFrame, list[str]]:
    """Rows with key and time, the time as ``_time``, and the columns to group windows by."""
    placed = events.filter(F.col(key).isNotNull() & F.col(time).isNotNull()).withColumn("_time", F.col(time).cast("timestamp"))
    slices = skew.heavy_slices(placed, key, "_time", policy)
    if not slices:
        return placed, [key]
    return skew.add_slice(placed, key, "_time", slices.cuts), [key, "_slice"]


def _running(df: DataFrame, values: dict[str, Column], groups: list[str]) -> DataFrame:
    """Add the key's running total of each of ``values`` up to and with all rows of the same time."""
    along = Window.partitionBy(*groups).orderBy("_time").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    out = df.withColumns({name: F.sum(value).over(along) for name, value in values.items()})
    if len(groups) == 1:
        return out
    earlier = Window.partitionBy(groups[0]).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    before = {name: f"_before{i}" for i, name in enumerate(values)}
    totals = df.filter("_slice > 0").groupBy(*groups).agg(*[F.sum(value).alias(before[name]) for name, value in values.items()])
    totals = totals.withColumns({b: F.sum(b).over(earlier) for b in before.values()})
    out = out.join(totals.filter(" or ".join(f"{b} is not null" for b in before.values())), groups, "left")
    # a total of nulls alone is null, and stays so
    total = lambda name, b: F.when(F.col(name).isNull(), F.col(b)).otherwise(F.col(name) + F.coalesce(b, F.lit(0)))
    return out.withColumns({name: total(name, b) for name, b in before.items()}).drop(*before.values())


def with_sessions(events: DataFrame, key: str, time: str, gap: Column, policy: SkewPolicy = EVENT_POLICY) -> DataFrame:
    """``events`` with ``session_start`` and ``session_number``, from 1 within the key.

    A session ends where the key has no event for longer than ``gap`` (an interval).  Events of
    one time are in one session.  An event without key or time is in none and has nulls.
    """
    placed, groups = _cut(events, key, time, policy)
    placed = skew.beside(placed, -1, F.col("_time"), F.max("_time"), [key], ["_time"], "_last")
    begins = F.col("_last").isNull() | (F.col("_last") + gap < F.col("_time"))
    placed = placed.withColumn("_begins", begins.cast("long")).drop("_last")
    placed = _running(placed, {"session_number": F.col("_begins")}, groups)
    # the last begin is the largest so far
    begin = F.when(F.col("_begins") == 1, F.col("_time"))
    along = Window.partitionBy(*groups).orderBy("_time")
    out = placed.withColumn("session_start", F.max(begin).over(along))
    if len(groups) > 1:
        earlier = Window.partitionBy(key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
        ends = placed.filter("_slice > 0").groupBy(*groups).agg(F.max(begin).alias("_end"))
        ends = ends.withColumn("_before", F.max("_end").over(earlier)).drop("_end").filter("_before is not null")
        out = out.join(ends, groups, "left").withColumn("session_start", F.coalesce("session_start", "_before"))
    lone = events.filter(F.col(key).isNull() | F.col(time).isNull())
    lone = lone.select(*events.columns, F.lit(None).cast("timestamp").alias("session_start"), F.lit(None).cast("long").alias("session_number"))
    return out.select(*events.columns, "session_start", "session_number").unionAll(lone)


def session_summary(events: DataFrame, key: str, time: str, gap: Column, *measures: Column, policy: SkewPolicy = EVENT_POLICY) -> DataFrame:
    """One row for each session: key, ``session_number``, begin, end, ``events`` and ``measures`` (aggregates)."""
    found = with_sessions(events, key, time, gap, policy).filter("session_start is not null")
    return found.groupBy(key, "session_number").agg(
        F.min("session_start").alias("session_start"),
        F.max(F.col(time).cast("timestamp")).alias("session_end"),
        F.count("*").alias("events"),
        *measures,
    )


def rolling_sums(
    events: DataFrame, key: str, time: str, width: Column, sums: dict[str, Column], policy: SkewPolicy = EVENT_POLICY
) -> DataFrame:
    """``events`` with the sum of each of ``sums`` over the key's rows of the last ``width`` (an interval).

    The frame goes from exactly ``width`` before the row to all rows of its own time; nulls add nothing, and a frame
    without values sums to null.  Use exact types (integers, decimals): running totals are subtracted.  An event without
    key or time gets nulls.
    """
    placed, groups = _cut(events, key, time, policy)
    times = placed.select(key, "_time")
    places = times.union(times.select(key, F.col("_time") - width))
    counts = {f"_n_{name}": F.when(value.isNotNull(), 1).otherwise(0).cast("long") for name, value in sums.items()}
    totals = {**{f"_s_{name}": value for name, value in sums.items()}, **counts}
    columns = {f"_v{i}": value for i, value in enumerate(totals.values())}
    placed = placed.withColumns(columns)
    placed = _running(placed, {name: F.col(value) for name, value in zip(totals, columns, strict=True)}, groups)
    placed = placed.drop(*columns, "_slice").withColumn("_lower", F.col("_time") - width)
    # rows of one time have one total
    edges = placed.select(key, F.col("_time").alias("_edge"), *[F.col(t).alias(f"_before{t}") for t in totals])
    found = asof_join(placed, edges, key, "_lower", "_edge", strict=True, policy=policy, places=places)

    def difference(name: str) -> Column:
        before = lambda t: F.coalesce(f"_before{t}", F.lit(0))
        inside = F.col(f"_n_{name}") - before(f"_n_{name}")
        return F.when(inside > 0, F.col(f"_s_{name}") - before(f"_s_{name}")).alias(name)

    found = found.select(*events.columns, *[difference(name) for name in sums])
    lone = events.filter(F.col(key).isNull() | F.col(time).isNull())
    return found.unionAll(lone.select(*events.columns, *[F.lit(None).cast(found.schema[n].dataType).alias(n) for n in sums]))
