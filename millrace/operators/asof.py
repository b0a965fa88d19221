"""As-of join: for each row the last earlier row of another table.

Both sides are put into one table, sorted by key and time, and the right side's rows
are carried forward to the left side's: one shuffle on the key, no pairs of rows.  A key
that holds a large share of the rows is cut along time (``skew``), and what a slice
begins with is carried over from the slices before it.  Where very many rows share a
key and a time, the right side is first reduced to the last row of each, and of the left
rows at such an instant one asks for all.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.operators import skew
from millrace.operators.skew import DEFAULT_POLICY, SkewPolicy


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    left_time: str,
    right_time: str,
    tie: Sequence[str] = (),
    strict: bool = False,
    within: Column | None = None,
    how: str = "left",
    prefix: str = "",
    policy: SkewPolicy = DEFAULT_POLICY,
    places: DataFrame | None = None,
) -> DataFrame:
    """``left`` with the columns of the last row of ``right`` that is not later.

    Rows match on the columns ``on``, which both have.  Of right rows with one time
    the last by ``tie`` counts; rows equal in those too are told apart by all their
    columns, so the result is the same every time.  ``strict`` asks for an earlier
    time, ``within`` (an interval) for one that is not longer ago.  ``how="inner"``
    drops rows without a match.

    A null key or time matches nothing, on either side; such left rows stay, without a
    match, in a left join.  ``right``'s columns but ``on`` follow, named with
    ``prefix``; a name that is taken is an error.

    Heavy keys are looked for in ``places``, key and time of the rows of both sides, for a
    caller that has them at less cost than the sides.
    """
    on = [on] if isinstance(on, str) else list(on)
    taken = {c.lower() for c in left.columns}
    brought = [c for c in right.columns if c not in on]
    clash = [prefix + c for c in brought if (prefix + c).lower() in taken]
    if clash:
        raise ValueError(f"columns on both sides: {clash}")
    if how not in ("left", "inner"):
        raise ValueError(f"how={how!r}: left or inner")

    key = F.col(on[0]) if len(on) == 1 else F.struct(*on)
    complete = lambda time: F.expr(" and ".join(f"`{c}` is not null" for c in [*on, time]))
    row = F.struct(*[F.col(c).alias(prefix + c) for c in brought])
    order = F.struct(*[F.col(c) for c in tie], *[_sortable(right, c) for c in brought if c not in tie])
    known = right.filter(complete(right_time)).select(
        key.alias("_key"),
        F.col(right_time).cast("timestamp").alias("_time"),
        F.lit(2 if strict else 0).alias("_turn"),
        order.alias("_order"),
        row.alias("_row"),
    )
    asking = left.filter(complete(left_time)).select(
        key.alias("_key"),
        F.col(left_time).cast("timestamp").alias("_time"),
        F.lit(1).alias("_turn"),
        F.struct(*left.columns).alias("_asks"),
    )
    if places is None:
        places = known.select("_key", "_time").union(asking.select("_key", "_time"))
    slices = skew.heavy_slices(places.toDF("_key", "_time"), "_key", "_time", policy)
    if slices and slices.instants is not None:
        found = _with_heavy_instants(known, asking, slices)
    else:
        found = _carried(known, asking, slices)
    if within is not None:
        fresh = F.col(f"_row.`{prefix + right_time}`").cast("timestamp") + within >= F.col("_time")
        found = found.withColumn("_row", F.when(fresh, F.col("_row")))
    columns = [*[F.col(f"_asks.`{c}`") for c in left.columns], *[F.col(f"_row.`{prefix + c}`") for c in brought]]
    if how == "inner":
        return found.filter("_row is not null").select(*columns)
    missing = [F.lit(None).cast(right.schema[c].dataType).alias(prefix + c) for c in brought]
    lone = left.filter(~F.coalesce(complete(left_time), F.lit(False))).select(*left.columns, *missing)
    return found.select(*columns).unionAll(lone)


def _sortable(df: DataFrame, column: str) -> Column:
    """The column, or its text where its type has no order."""
    kind = df.schema[column].dataType.simpleString()
    return F.to_json(F.struct(column)) if "map<" in kind or "variant" in kind else F.col(column)


def _carried(known: DataFrame, asking: DataFrame, slices) -> DataFrame:
    """``asking`` with the row carried forward to it as ``_row``."""
    both = known.unionByName(asking, allowMissingColumns=True)
    groups = ["_key"]
    if slices:
        both = skew.add_slice(both, "_key", "_time", slices.cuts)
        groups.append("_slice")
    within = Window.partitionBy(*groups).orderBy("_time", "_turn", "_order")
    out = both.withColumn("_carried", F.last("_row", ignorenulls=True).over(within))
    if slices:
        place = F.when(F.col("_row").isNotNull(), F.struct("_time", "_order"))
        ends = both.filter("_slice > 0").groupBy(*groups).agg(F.max_by("_row", place).alias("_end"))
        earlier = Window.partitionBy("_key").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
        ends = ends.withColumn("_before", F.last("_end", ignorenulls=True).over(earlier)).drop("_end")
        out = out.join(ends.filter("_before is not null"), groups, "left")
        out = out.withColumn("_carried", F.coalesce("_carried", "_before"))
    return out.filter("_asks is not null").select("_key", "_time", "_asks", F.col("_carried").alias("_row"))


def _with_heavy_instants(known: DataFrame, asking: DataFrame, slices) -> DataFrame:
    """As ``_carried``, with one row for each key and time on the right, and for each heavy one on the left.

    Heavy instants are few by the policy's bound, so are the answers.
    """
    known = known.groupBy("_key", "_time", "_turn").agg(F.max_by("_row", "_order").alias("_row"), F.max("_order").alias("_order"))
    at = F.col("_key").eqNullSafe(F.col("_heavy_key")) & (F.unix_micros("_time") == F.col("_micros"))
    piled = asking.join(F.broadcast(slices.instants), at, "left_semi")
    single = piled.groupBy("_key", "_time", "_turn").agg(F.first("_asks").alias("_asks"))
    answers = _carried(known, single, slices).select(
        F.col("_key").alias("_heavy_key"), F.unix_micros("_time").alias("_micros"), "_row"
    )
    answered = piled.join(F.broadcast(answers), at, "left").select("_key", "_time", "_asks", "_row")
    others = asking.join(F.broadcast(slices.instants), at, "left_anti")
    return _carried(known, others, slices).unionByName(answered)
