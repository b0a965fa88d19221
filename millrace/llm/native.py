"""Column helpers of the operators that use DataFrame functions only."""

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, functions as F


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, also where the body uses it in a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def ascii_lower(text: Column) -> Column:
    """A to Z in lower case, everything else as it is."""
    return F.when(text.rlike(r"[^\x00-\x7F]"), F.translate(text, ascii_uppercase, ascii_lowercase)).otherwise(F.lower(text))


def row_key(*columns: str) -> Column:
    """16 bytes that name a row by the content of the columns; nulls count as a value."""
    parts = []
    for name in columns:
        value = F.col(name).cast("long" if name == "doc_id" else "string").cast("string")
        parts += [F.coalesce(F.length(value).cast("string"), F.lit("-")), F.lit(":"), F.coalesce(value, F.lit(""))]
    return F.unhex(F.md5(F.concat(*parts).cast("binary")))


def fresh(docs: DataFrame, name: str) -> str:
    """``name``, or one like it that ``docs`` does not have."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
