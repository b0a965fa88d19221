"""Reproducible draws: a value depends on seed, label and id only.

``rand(seed)`` depends on how rows are partitioned; a digest of the row's id does
not, so a table comes out the same on any cluster and after any retry.
"""

from pyspark.sql import Column, functions as F


def digest(seed: int, label: str, id_column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit(label), id_column))


DRAW_DIGITS = 15


def draw(seed: int, label: str, id_column, below: int) -> Column:
    """An integer in [0, below), from 60 bits of the digest."""
    if not 0 < below <= 16**DRAW_DIGITS:
        raise ValueError(f"below must lie in 1..2^60, not {below}")
    head = F.substring(digest(seed, label, id_column), 1, DRAW_DIGITS)
    return F.conv(head, 16, 10).cast("bigint") % F.lit(below)


def pick(seed: int, label: str, id_column, values) -> Column:
    index = draw(seed, label, id_column, len(values)).cast("int")
    return F.get(F.array(*[F.lit(v) for v in values]), index)


def uuid_text(seed: int, label: str, id_column) -> Column:
    """A digest in the 8-4-4-4-12 form of a UUID."""
    hexes = digest(seed, label, id_column)
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat_ws("-", *[F.substring(hexes, at, n) for at, n in cuts])


def instant_text(start: str, seconds: Column) -> Column:
    """ISO-8601 text with Z, ``seconds`` after midnight of date ``start``."""
    moment = F.lit(start).cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)
    return F.concat(
        F.replace(moment.cast("string"), F.lit(" "), F.lit("T")), F.lit("Z")
    )
