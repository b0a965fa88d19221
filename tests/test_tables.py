"""Raw sales from awkward star-schema tables, against their SQL, what their joins shuffle, and drops of text."""

import os
import re
from datetime import datetime

import duckdb
import pytest
from pyspark.sql import functions as F

from millrace import schemas
from millrace.plans import tables
from millrace.plans.oracles import RAW
from millrace.sinks.formats import write_drop
from millrace.sources import files

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")

# Nulls in every column that a rule asks for.
SPOILED = {
    "lineitem": {c: f"CASE WHEN (l_orderkey + l_linenumber) % {n} <> 0 THEN {c} END" for c, n in (("l_discount", 5), ("l_tax", 7), ("l_linenumber", 11), ("l_quantity", 13), ("l_extendedprice", 17))},
    "orders": {c: f"CASE WHEN o_orderkey % {n} <> 0 THEN {c} END" for c, n in (("o_orderstatus", 3), ("o_orderpriority", 5), ("o_orderdate", 7))},
    "customer": {"c_acctbal": "CASE WHEN c_custkey % 3 <> 0 THEN c_acctbal END"},
    "part": {"p_size": "CASE WHEN p_partkey % 3 <> 0 THEN p_size END", "p_retailprice": "CASE WHEN p_partkey % 4 <> 0 THEN p_retailprice END"},
}


def test_raw_sales_with_nulls(spark, tmp_path):
    sql = duckdb.connect()
    for name in ("lineitem", "orders", "customer", "part", "nation", "region"):
        spoil = ", ".join(f"{value} AS {column}" for column, value in SPOILED.get(name, {}).items())
        sql.execute(f"COPY (SELECT * {f'REPLACE ({spoil})' if spoil else ''} FROM '{SF}/{name}.parquet') TO '{tmp_path}/{name}.parquet' (FORMAT parquet)")
        sql.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet'")
    expected = sorted(map(repr, sql.execute(f"WITH {RAW} SELECT * FROM raw").fetchall()))
    assert sorted(repr(tuple(r)) for r in tables.raw_sales(spark, str(tmp_path)).collect()) == expected
    assert expected


def test_lines_take_only_what_sales_need_to_their_part(spark, plan):
    other = spark.newSession()
    other.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    text = plan(tables.raw_sales(other, SF))
    moved = re.findall(r"Input \[\d+\]: \[([^]]*)\]\nArguments: hashpartitioning\(l_partkey", text)
    assert len(moved) == 1
    names = {re.sub(r"#\d+L?$", "", c.strip()) for c in moved[0].split(",")}
    assert names == {"l_partkey", "order_key", "o_custkey", "total", "o_orderdate", "pending", "quantity", "region"}


@pytest.mark.parametrize("dataset, reader", [("sales", files.read_csv), ("users", files.read_users)])
def test_text_drops_are_compressed(spark, tmp_path, rows, dataset, reader):
    names = schemas.SALES_COLUMNS if dataset == "sales" else schemas.USER_COLUMNS
    columns = [F.lit(True) if n == "is_active" else F.concat(F.lit(f"{n} "), F.col("id")) for n in names]
    df = spark.range(2000, numPartitions=2).select(*[c.alias(n) for c, n in zip(columns, names, strict=True)])
    path = write_drop(df, dataset, str(tmp_path), datetime(2024, 1, 1))
    parts = [p for p in os.listdir(path) if p.startswith("part-")]
    assert parts and all(p.endswith(".gz") for p in parts)
    assert rows(reader(spark, path)) == rows(df)
