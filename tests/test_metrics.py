import pytest
from py4j.protocol import Py4JJavaError
from pyspark.sql import Observation, functions as F

from millrace import schemas
from millrace.operators import metrics
from millrace.operators.clean import clean_sales
from millrace.sources.files import inline_table


def raw(spark):
    row = ("p", "c", "1", "2.0", "2.0", "u", "2024-01-15T10:30:00Z", "r")
    return inline_table(spark, [(i, *row) for i in ("b", None, "a", None, "c")])


def test_row_metrics(spark):
    assert metrics.row_metrics(raw(spark)).first().asDict() == {
        "rows_read": 5,
        "rows_kept": 3,
    }


def test_counts_along_the_way_take_one_action(spark):
    before, after = Observation(), Observation()
    df = metrics.counted(clean_sales(metrics.counted(raw(spark), before)), after)
    df.write.format("noop").mode("overwrite").save()
    assert (before.get["rows"], after.get["rows"]) == (5, 3)


def test_preview(spark):
    df = spark.range(100).select((99 - F.col("id")).alias("n"))
    assert metrics.preview(df).count() == 5
    assert [r["n"] for r in metrics.preview(df, 3, ordered=True).collect()] == [0, 1, 2]
    assert metrics.preview(raw(spark).limit(0)).count() == 0


def test_schema_report(spark):
    report = metrics.schema_report(clean_sales(raw(spark))).orderBy("position").collect()
    assert [r["column"] for r in report] == schemas.CLEAN_SALES.names
    types = {r["column"]: r["type"] for r in report}
    assert types["quantity"] == "int"
    assert types["unit_price"] == types["revenue"] == "double"
    assert types["order_date"] == "date"


def test_filled(spark):
    counts = {r["column"]: r["filled"] for r in metrics.filled(raw(spark)).collect()}
    assert counts["order_id"] == 3
    assert counts["region"] == 5


def test_a_failing_observation_is_raised(spark):
    class Broken:
        @property
        def get(self):
            return spark.sparkContext._jvm.java.util.ArrayList().get(3)

    with pytest.raises(Py4JJavaError):
        metrics.observed(Broken())
