import datetime

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from millrace.functions import casts

INTS = {
    "5": 5, " 5 ": 5, "\t5\n": 5, "+7": 7, "007": 7, "-12": -12,
    "3.7": 3, "-3.7": -3, "3.": 3, ".5": 0, "-.5": 0, ".": 0, " 4.9 ": 4,
    "-2147483648.9": -2147483648, "2147483647": 2147483647,
    "": None, "-": None, "1e3": None, "N/A": None, "5d": None, "5.5.5": None,
    "1,000": None, "3000000000": None, "2147483648.5": None, "4 5": None,
    None: None,
}
DOUBLES = {
    "19.99": 19.99, "1e3": 1000.0, "5d": 5.0, "Infinity": float("inf"),
    "1e400": float("inf"), " 2.5 ": 2.5,
    "": None, "N/A": None, "1,000": None, "0x10": None, None: None,
}
DATES = {
    "2026-05-19T22:45:06Z": datetime.date(2026, 5, 19),
    "2026-05-19T23:59:59-11:00": datetime.date(2026, 5, 19),
    "2026-05-19 01:00:00": datetime.date(2026, 5, 19),
    "2026-5-9": datetime.date(2026, 5, 9),
    "2026-05": datetime.date(2026, 5, 1),
    "2026-05-19Tjunk": datetime.date(2026, 5, 19),
    "": None, "05/19/2026": None, "2026-13-01": None, "2026-02-30": None,
    "2026-05-19junk": None, None: None,
}


def apply(spark, function, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in df.select(function("v")).collect()]


@pytest.mark.parametrize(
    "function, expected",
    [(casts.to_int, INTS), (casts.to_double, DOUBLES), (casts.to_date, DATES)],
)
def test_value_tables(spark, function, expected):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    assert apply(spark, function, expected) == list(expected.values())


def test_nan_is_a_double(spark):
    (value,) = apply(spark, casts.to_double, ["NaN"])
    assert value != value


@pytest.mark.parametrize("zone", ["Asia/Tokyo", "America/Los_Angeles"])
def test_date_ignores_the_session_zone(spark, zone):
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", zone)
    text = "2026-05-19T22:45:06Z"
    assert apply(other, casts.to_date, [text]) == [DATES[text]]


NUMBERISH = st.text(alphabet="0123456789+-. eE\t\n,dfNaInity", max_size=12)


@settings(
    max_examples=15,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(values=st.lists(NUMBERISH, min_size=50, max_size=200))
def test_agrees_with_the_lenient_cast(spark, values):
    """Each function accepts exactly what a cast outside ANSI mode accepts."""
    lenient = spark.newSession()
    lenient.conf.set("spark.sql.ansi.enabled", "false")
    for function, kind in ((casts.to_int, "int"), (casts.to_double, "double")):
        df = lenient.createDataFrame([(v,) for v in values], "v string")
        old = [str(r[0]) for r in df.select(F.col("v").cast(kind)).collect()]
        new = [str(v) for v in apply(spark, function, values)]
        assert new == old


def test_casts_stay_in_generated_code(spark, plan):
    text = plan(spark.range(9).select(F.col("id").cast("string").alias("v")).select(casts.to_int("v")))
    assert "EvalPython" not in text
    assert "Project [codegen id" in text


DATEISH = st.text(alphabet="0123456789-+:TZ /.\t", max_size=22)


@settings(
    max_examples=10,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(
    values=st.lists(
        st.one_of(
            DATEISH,
            st.dates().map(str),
            st.datetimes().map(lambda t: t.isoformat() + "Z"),
        ),
        min_size=50,
        max_size=200,
    )
)
def test_dates_agree_with_the_lenient_cast(spark, values):
    lenient = spark.newSession()
    lenient.conf.set("spark.sql.ansi.enabled", "false")
    df = lenient.createDataFrame([(v,) for v in values], "v string")
    old = [str(r[0]) for r in df.select(F.to_date("v").cast("string")).collect()]
    new = [str(v) for v in apply(spark, lambda v: casts.to_date(v).cast("string"), values)]
    assert new == old


ODD_DOUBLES = [
    "+NaN", "-nan", "INF", "+Infinity", "-inf", " infinity ", "0x1p3", "0x1.8P1d",
    "1.", ".5", "1.e2", "1E+5", "5D", "5F", "5L", "1e", "e5", "0x10", "1_000", "--1",
]


def test_odd_doubles_agree_with_the_lenient_cast(spark):
    lenient = spark.newSession()
    lenient.conf.set("spark.sql.ansi.enabled", "false")
    df = lenient.createDataFrame([(v,) for v in ODD_DOUBLES], "v string")
    old = [str(r[0]) for r in df.select(F.col("v").cast("double")).collect()]
    assert [str(v) for v in apply(spark, casts.to_double, ODD_DOUBLES)] == old
