"""Every registered query against its SQL twin, on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as registry
from millrace.plans.oracles import ORACLES
from millrace.plans.queries import QUERIES

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TYPES = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
    "date": "DATE", "boolean": "BOOLEAN", "timestamp": "TIMESTAMP",
}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in os.listdir(SF):
        view, extension = os.path.splitext(name)
        if extension == ".parquet":
            connection.execute(f"CREATE VIEW {view} AS SELECT * FROM '{SF}/{name}'")
    return connection


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= registry.queries().keys()
    assert ORACLES.keys() <= registry.oracle_sql().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_matches_sql(spark, sql, name):
    df = registry.queries()[name](spark, SF)
    cursor = sql.execute(registry.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    assert {c: TYPES[t] for c, t in df.dtypes} == kinds
    found = sorted(map(repr, (tuple(r) for r in df.select(*[f"`{n}`" for n in names]).collect())))
    expected = sorted(map(repr, cursor.fetchall()))
    assert found == expected
    assert found


def test_entry(spark):
    df = registry.entry(spark)
    assert df.columns == ["order_date", "region", "order_count", "units", "revenue"]
    assert df.count() > 0
