"""Text to value, null on failure, with the session left in ANSI mode.

A plain cast raises on bad text in ANSI mode.  ``try_cast`` does not, and for
double and date it accepts exactly what a non-ANSI cast accepts.  For integers
it is stricter: a non-ANSI cast also truncates decimals ("3.7" -> 3).

Inside, ``try_cast`` builds and catches an exception for each bad value, at a
cost of some 15 microseconds.  So each function first tests how the text starts,
which takes a fraction of one; the test may let bad text through to ``try_cast``
but never holds good text back.
"""

from pyspark.sql import Column, functions as F

_PAD = r"[\x00-\x20]*"
_SHORT_INT = "^[+-]?[0-9]{1,9}$"
_NUMBER = rf"^{_PAD}([+-]?[0-9]+)(\.[0-9]*)?{_PAD}$"
_FRACTION = rf"^{_PAD}[+-]?\.[0-9]*{_PAD}$"
_DOUBLE_SHAPE = rf"(?i)^{_PAD}[+-]?([0-9.]|nan|inf)"
_DATE_SHAPE = rf"^{_PAD}[+-]?[0-9]{{4}}"


def _column(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_double(c) -> Column:
    text = _column(c)
    return F.when(text.rlike(_DOUBLE_SHAPE), text.try_cast("double"))


def to_int(c) -> Column:
    """The integer part of numeric text, null if it does not fit an int."""
    text = _column(c)
    return (
        F.when(text.rlike(_SHORT_INT), text.try_cast("int"))
        .when(text.rlike(_NUMBER), F.regexp_extract(text, _NUMBER, 1).try_cast("int"))
        .when(text.rlike(_FRACTION), F.lit(0))
    )


def to_date(c) -> Column:
    """Date part of an ISO timestamp as written; the session zone plays no role."""
    text = _column(c)
    return F.when(text.rlike(_DATE_SHAPE), text.try_cast("date"))


def to_instant(c) -> Column:
    """ISO-8601 text with zone to a timestamp, for ordering changes."""
    return _column(c).try_cast("timestamp")
