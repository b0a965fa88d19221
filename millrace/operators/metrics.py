"""Row counts, previews and schema listings."""

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, functions as F


def row_metrics(df: DataFrame, required: str = "order_id") -> DataFrame:
    """Rows read and rows kept by the not-null filter, in one pass.

    A query result, so it stays exact when tasks are retried; over CSV it parses
    only the one column.
    """
    return df.agg(
        F.count(F.lit(1)).alias("rows_read"), F.count(required).alias("rows_kept")
    )


def counted(df: DataFrame, observation: Observation) -> DataFrame:
    """Count rows as they pass, for free, into ``observation.get["rows"]``.

    Placed before a shuffle it may count a map task twice if a lost executor
    makes Spark run it again; in the last stage of a job it is exact.
    """
    return df.observe(observation, F.count(F.lit(1)).alias("rows"))


def observed(observation: Observation) -> dict:
    """Values of an observation after its action.

    Empty where adaptive execution saw that no row reaches the end of the plan
    and dropped the plan, observation included: Spark then fails an assertion when
    it turns the missing row into a Python one.  Any other failure is raised.
    """
    try:
        return observation.get
    except Py4JJavaError as error:
        failure = error.java_exception
        places = [frame.getMethodName() for frame in failure.getStackTrace()[:3]]
        if failure.getClass().getName() != "java.lang.AssertionError" or "toPyRow" not in places:
            raise
        return {}


def preview(df: DataFrame, rows: int = 5, ordered: bool = False) -> DataFrame:
    """A few rows to look at: any, or with ``ordered`` the first by all columns."""
    return (df.orderBy(*df.columns) if ordered else df).limit(rows)


def schema_report(df: DataFrame) -> DataFrame:
    """Column name, type, nullability and position as a table."""
    rows = [
        (f.name, f.dataType.simpleString(), f.nullable, i)
        for i, f in enumerate(df.schema.fields)
    ]
    return df.sparkSession.createDataFrame(
        rows, "`column` string, type string, nullable boolean, position int"
    )


def filled(df: DataFrame) -> DataFrame:
    """Number of non-null values of each column, in one pass."""
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns])
    return counts.unpivot([], df.columns, "column", "filled")
