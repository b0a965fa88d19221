"""Change logs: current state and type-2 history.

A change log has a key, an ``operation``, an ``updated_at`` and the attributes.
Changes are ordered by ``updated_at``, then by tie columns that make the order
total.  INSERT on a live key acts as UPDATE, UPDATE on an absent key as INSERT,
DELETE on an absent key does nothing.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from millrace.functions import casts
from millrace.operators import skew
from millrace.operators.skew import DEFAULT_POLICY, SkewPolicy
from millrace.schemas import CHANGE_OPERATIONS


def check_changes(changes: DataFrame, key: str = "order_id") -> DataFrame:
    """Type ``updated_at`` and add ``reject_reason``, null for a usable change."""
    typed = changes.withColumn("updated_at", casts.to_instant("updated_at"))
    reason = (
        F.when(F.col(key).isNull(), "missing key")
        .when(
            F.col("operation").isNull()
            | ~F.col("operation").isin(*CHANGE_OPERATIONS),
            "unknown operation",
        )
        .when(F.col("updated_at").isNull(), "unreadable updated_at")
    )
    return typed.withColumn("reject_reason", reason)


def usable(checked: DataFrame) -> DataFrame:
    return checked.filter("reject_reason is null").drop("reject_reason")


def rejected(checked: DataFrame) -> DataFrame:
    return checked.filter("reject_reason is not null")


def _attributes(changes: DataFrame, key: str, tie: Sequence[str]) -> list[str]:
    skip = {key, "operation", "updated_at", *tie}
    return [c for c in changes.columns if c not in skip]


def current_state(
    changes: DataFrame, key: str = "order_id", tie: Sequence[str] = ("change_id",)
) -> DataFrame:
    """The last change of each key, without deleted keys.

    An aggregate rather than a window: it combines before the shuffle, so each
    task sends one row per key however often the key changed.
    """
    order = F.struct("updated_at", *tie)
    last = F.struct("operation", "updated_at", *_attributes(changes, key, tie))
    return (
        changes.groupBy(key)
        .agg(F.max_by(last, order).alias("last"))
        .select(key, "last.*")
        .filter("operation <> 'DELETE'")
        .drop("operation")
    )


def scd2_history(
    changes: DataFrame,
    key: str = "order_id",
    tie: Sequence[str] = ("change_id",),
    collapse_unchanged: bool = False,
    policy: SkewPolicy = DEFAULT_POLICY,
    probe: DataFrame | None = None,
) -> DataFrame:
    """One row per version with ``valid_from``, ``valid_to`` and ``is_current``.

    Each INSERT or UPDATE opens a version that the key's next change of any kind
    closes; a DELETE opens none.  Where changes share a key and a time only the
    last by tie counts.  ``collapse_unchanged`` joins a version to an equal one
    that it directly follows.

    A change without a time has no place in a history and is left out; null is a
    key like any other.  A key with a large share of the log is cut along time and
    each part windowed on its own.  Where ``changes`` is derived, ``probe`` names a
    log to look for such keys in.
    """
    attributes = _attributes(changes, key, tie)
    order = ["valid_from", *tie]
    log = changes.withColumnRenamed("updated_at", "valid_from").filter("valid_from is not null")

    slices = skew.heavy_slices(
        changes if probe is None else probe, key, "updated_at", policy
    )
    if slices:
        if slices.instants is not None:
            log = _last_at_heavy_instants(log, key, tie, slices.instants)
        log = skew.add_slice(log, key, "valid_from", slices.cuts)
    log, keys = skew.join_columns(log, key, bool(slices and slices.null_key))

    def with_next_time(df, name):
        first = F.min("valid_from")
        return skew.beside(df, 1, F.col("valid_from"), first, keys, order, name)

    if collapse_unchanged:
        log = with_next_time(log, "_next_time").filter(
            "_next_time is null or _next_time > valid_from"
        )
        state = F.struct("operation", *attributes)
        last = F.max_by(state, F.struct(*order))
        log = skew.beside(log, -1, state, last, keys, order, "_before")
        repeats = F.col("_before").isNotNull() & F.expr(
            "'DELETE' not in (operation, _before.operation)"
        )
        for attribute in attributes:
            before = F.col("_before")[attribute]
            repeats = repeats & F.col(attribute).eqNullSafe(before)
        log = log.filter(~repeats).drop("_before", "_next_time")

    return (
        with_next_time(log, "valid_to")
        .filter("operation <> 'DELETE' and (valid_to is null or valid_to > valid_from)")
        .select(
            key,
            *attributes,
            "valid_from",
            "valid_to",
            F.col("valid_to").isNull().alias("is_current"),
        )
    )


def _last_at_heavy_instants(
    log: DataFrame, key: str, tie: Sequence[str], instants: DataFrame
) -> DataFrame:
    """Keep only the last change at each heavy (key, time).

    The others would be versions of zero length.  The maximum combines before
    its shuffle and leaves one row per instant, so the pile never meets in one
    task.
    """
    at = F.col(key).eqNullSafe(F.col("_heavy_key")) & (
        F.unix_micros("valid_from") == F.col("_micros")
    )
    # one row for each instant, of the tie columns alone
    last = (
        log.join(F.broadcast(instants), at)
        .groupBy("_heavy_key", "_micros")
        .agg(F.max(F.struct(*tie)).alias("_last_tie"))
    )
    return (
        log.join(F.broadcast(last), at, "left")
        .filter(F.col("_last_tie").isNull() | (F.col("_last_tie") == F.struct(*tie)))
        .drop("_heavy_key", "_micros", "_last_tie")
    )


def scd2_incremental(
    history: DataFrame,
    log: DataFrame,
    batch: DataFrame,
    key: str = "order_id",
    tie: Sequence[str] = ("change_id",),
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """History after ``batch``; ``log`` is the whole change log, batch included.

    A key whose new changes all follow its old ones only has its open version closed
    and new ones added.  A key with a late change is rebuilt from the log.  Of the
    log two columns are read to tell them apart, and the rest for late keys only;
    closed versions of all other keys pass through as they are.
    """
    new = batch.filter("updated_at is not null")
    touched = new.groupBy(F.col(key).alias("touched_key")).agg(
        F.min("updated_at").alias("first_new"), F.count(F.lit(1)).alias("n_new")
    )
    same_key = F.col(key).eqNullSafe(F.col("touched_key"))
    after = (
        log.select(key, "updated_at")
        .join(touched, same_key)
        .filter("updated_at >= first_new")
        .groupBy("touched_key")
        .agg((F.count(F.lit(1)) > F.first("n_new")).alias("late"))
    )
    late = after.filter("late").select("touched_key")
    prompt = after.filter("not late").select("touched_key")

    known = history.join(after, same_key, "left")
    kept = known.filter("late is null or not (late or is_current)").select(*history.columns)
    rebuilt = scd2_history(
        log.join(late, same_key, "left_semi"), key, tie, policy=policy, probe=log
    )
    first = history.filter("is_current").join(prompt, same_key, "left_semi")
    onward = as_changes(first, log).unionByName(
        new.join(prompt, same_key, "left_semi").select(*log.columns)
    )
    advanced = scd2_history(onward, key, tie, policy=policy, probe=batch)
    return kept.unionByName(rebuilt).unionByName(advanced)


def as_changes(versions: DataFrame, log: DataFrame) -> DataFrame:
    """Open versions as changes with the columns of ``log``; they come before ties."""
    known = {"operation": F.lit("UPDATE"), "updated_at": F.col("valid_from")}
    return versions.select(
        *[
            known.get(f.name, F.col(f.name) if f.name in versions.columns else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in log.schema.fields
        ]
    )
