"""Difference of two table states as a change log.

The comparison reads every row once to a digest of its columns and shuffles keys and
digests only; whole rows are fetched for the keys that differ.  With a partition
column, partitions whose rows have the same digests in all are left out before that.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Row digests are sums of two 64-bit hashes: rows are a multiset, in any order.
LANES = ("_a", "_b")


def _hashable(df: DataFrame, column: str) -> Column:
    """The column, or its text where Spark does not hash its type."""
    kind = df.schema[column].dataType.simpleString()
    return F.to_json(F.struct(F.col(f"`{column}`").alias("x"))) if "map<" in kind or "variant" in kind else F.col(f"`{column}`")


def _digests(df: DataFrame, keep: Sequence[str], columns: Sequence[str], sign: int) -> DataFrame:
    """``keep`` and a signed digest of each row; nulls are marked, as Spark's hash passes over them."""
    values = [v for c in columns for v in (F.col(f"`{c}`").isNull(), _hashable(df, c))]
    lanes = [F.xxhash64(F.lit(seed), *values).cast("decimal(20,0)") * F.lit(sign) for seed in range(2)]
    return df.select(
        *[F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(keep)],
        F.lit(sign).alias("_sign"),
        *[lane.cast("decimal(20,0)").alias(name) for lane, name in zip(lanes, LANES, strict=True)],
    )


def _compared(before: DataFrame, after: DataFrame, keep: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row for each value of ``keep`` (as ``_k0`` and so on) whose rows differ, with the counts of both sides."""
    both = _digests(before, keep, columns, -1).unionAll(_digests(after, keep, columns, 1))
    names = [f"_k{i}" for i in range(len(keep))]
    found = both.groupBy(*names).agg(
        F.count_if(F.col("_sign") < 0).alias("n_before"),
        F.count_if(F.col("_sign") > 0).alias("n_after"),
        *[F.sum(lane).alias(lane) for lane in LANES],
    )
    return found.filter(" or ".join(["n_before <> n_after", *[f"{lane} <> 0" for lane in LANES]])).drop(*LANES)


def _matching(df: DataFrame, keep: Sequence[str], names: DataFrame, how: str) -> DataFrame:
    same = F.lit(True)
    for i, c in enumerate(keep):
        same = same & F.col(f"`{c}`").eqNullSafe(F.col(f"_k{i}"))
    return df.join(names, same, how)


def snapshot_changes(
    before: DataFrame,
    after: DataFrame,
    key: str | Sequence[str],
    partition: str | Sequence[str] = (),
    ignore: Sequence[str] = (),
    at: Column | None = None,
) -> DataFrame:
    """INSERT, UPDATE and DELETE rows that turn ``before`` into ``after``.

    One row for each key that differs: ``operation``, the columns of the row as it is
    after (of a deleted key, as it was), ``n_before`` and ``n_after``, and, if ``at`` is
    given, that time as ``updated_at``, so that ``current_state`` and the histories take it.

    A key whose rows repeat differs if its rows do as a multiset, also in how often one is
    there; of several rows the one that sorts last stands for it.  Null is a key like any other, and
    nulls in columns are equal.  Columns in ``ignore`` are not compared.  ``partition`` changes
    what is shuffled, not the result.  Both sides must have the same columns.
    """
    key, partition = ([c] if isinstance(c, str) else list(c) for c in (key, partition))
    if sorted(before.columns) != sorted(after.columns):
        raise ValueError(f"columns differ: {sorted(set(before.columns) ^ set(after.columns))}")
    before = before.select(*[f"`{c}`" for c in after.columns])
    columns = [c for c in after.columns if c not in ignore]
    old, new = before, after
    if partition:
        touched = _compared(before, after, partition, columns).select(*[f"_k{i}" for i in range(len(partition))])
        old, new = (_matching(df, partition, touched, "left_semi") for df in (before, after))
    changed = _compared(old, new, key, columns)
    operation = F.when(F.col("n_before") == 0, "INSERT").when(F.col("n_after") == 0, "DELETE").otherwise("UPDATE")
    changed = changed.withColumn("operation", operation)

    def rows(df: DataFrame, wanted: str) -> DataFrame:
        found = _matching(df, key, changed.filter(wanted), "inner")
        names = [f"_k{i}" for i in range(len(key))]
        # keys are in the row too; rows with maps or variants sort by their text
        place = F.struct(*[_hashable(df, c) for c in df.columns])
        row = F.max_by(F.struct(*[F.col(f"`{c}`") for c in df.columns]), place)
        return found.groupBy(*names, "operation", "n_before", "n_after").agg(row.alias("_row"))

    found = rows(new, "operation <> 'DELETE'").unionAll(rows(old, "operation = 'DELETE'"))
    stamp = [] if at is None else [at.alias("updated_at")]
    return found.select(*[F.col(f"_row.`{c}`") for c in after.columns], "operation", *stamp, "n_before", "n_after")
