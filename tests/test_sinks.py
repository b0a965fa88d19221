import os
from datetime import datetime

import pytest
from pyspark.sql import Observation, functions as F

from millrace import schemas
from millrace.functions.routing import ROUTES
from millrace.operators.clean import clean_sales
from millrace.operators.skew import SkewPolicy
from millrace.plans import queries
from millrace.sinks import catalog
from millrace.sinks.formats import write_drop
from millrace.sinks.partitioned import is_committed, read_committed, write_partitioned
from millrace.sources import files


# Without adaptive execution, splits values with more than about 1,000 rows.
SMALL_CELLS = SkewPolicy(min_bytes=0, min_hits=50, cell_rows=1000)


def sales(spark, regions, product="Pen"):
    data = [
        (str(i), product, "Office", "2", "1.50", "3.00", "c", "2024-01-15T10:30:00Z", r)
        for i, r in enumerate(regions)
    ]
    return clean_sales(files.inline_table(spark, data))


def read(spark, path):
    return spark.read.schema(schemas.CLEAN_SALES).parquet(path)


def parquet_files(path):
    return [
        os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")
    ]


@pytest.mark.parametrize("layout", ["rebalance", "local"])
def test_round_trip_with_odd_regions(spark, tmp_path, rows, layout):
    path = str(tmp_path / "out")
    df = sales(spark, ["us", "1", "us, east", "a/b=c", None, ""])
    write_partitioned(df, path, layout=layout)
    back = read(spark, path)
    assert dict(back.dtypes)["region"] == "string"
    assert set(back.columns) == set(df.columns)
    # The folder for null also takes the empty text.
    expected = df.withColumn("region", F.nullif("region", F.lit("")))
    assert rows(back, *df.columns) == rows(expected)


def test_one_folder_and_one_file_per_small_region(spark, tmp_path):
    path = str(tmp_path / "out")
    regions = [f"r{i % 5}" for i in range(1000)]
    write_partitioned(sales(spark, regions).repartition(7), path)
    folders = {os.path.dirname(f) for f in parquet_files(path)}
    assert {os.path.basename(f) for f in folders} == {f"region=r{i}" for i in range(5)}
    assert len(parquet_files(path)) == 5


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_a_hot_region_is_written_by_many_tasks(spark, tmp_path, adaptive):
    other = spark.newSession()
    other.conf.set("spark.sql.adaptive.enabled", adaptive)
    other.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    path = str(tmp_path / "out")
    df = other.range(0, 200_000, numPartitions=8).select(
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
        F.when(F.col("id") % 3 > 0, "hot").otherwise(
            F.concat(F.lit("r"), F.col("id") % 40)
        ).alias("region"),
    )
    write_partitioned(df, path, policy=SMALL_CELLS)
    hot = [f for f in parquet_files(path) if "region=hot" in f]
    assert len(hot) >= 4
    biggest = max(other.read.parquet(f).count() for f in hot)
    assert biggest < 200_000 * 2 / 3 / 2
    assert other.read.parquet(path).count() == 200_000


def test_copies_of_one_row_spread_without_adaptive_execution(spark, tmp_path):
    other = spark.newSession()
    other.conf.set("spark.sql.adaptive.enabled", "false")
    path = str(tmp_path / "out")
    df = other.range(0, 8000, numPartitions=8).select(
        F.lit("same").alias("v"), F.lit("r").alias("region")
    )
    write_partitioned(df, path, policy=SMALL_CELLS)
    assert len(parquet_files(path)) > 1
    assert other.read.parquet(path).count() == 8000


def test_small_regions_are_one_file_without_adaptive_execution(spark, tmp_path):
    other = spark.newSession()
    other.conf.set("spark.sql.adaptive.enabled", "false")
    path = str(tmp_path / "out")
    write_partitioned(sales(other, [f"r{i % 5}" for i in range(1000)]), path)
    assert len(parquet_files(path)) == 5


def test_append_adds_and_overwrite_replaces_touched_folders(spark, tmp_path):
    path = str(tmp_path / "out")
    write_partitioned(sales(spark, ["a", "b"]), path)
    write_partitioned(sales(spark, ["a"]), path)
    assert read(spark, path).count() == 3
    for _ in range(2):
        write_partitioned(sales(spark, ["a"], "New"), path, mode="overwrite")
    found = sorted((r["region"], r["product_name"]) for r in read(spark, path).collect())
    assert found == [("a", "New"), ("b", "Pen")]
    write_partitioned(sales(spark, ["c"]), path, mode="replace")
    assert [r["region"] for r in read(spark, path).collect()] == ["c"]


@pytest.mark.parametrize("option", [{"mode": "ignore"}, {"layout": "sorted"}])
def test_unknown_options_fail(spark, tmp_path, option):
    with pytest.raises(ValueError):
        write_partitioned(sales(spark, ["a"]), str(tmp_path / "out"), **option)


@pytest.mark.parametrize("mode", ["append", "overwrite", "replace"])
def test_commit_marker(spark, tmp_path, mode):
    path = str(tmp_path / "out")
    with pytest.raises(FileNotFoundError):
        read_committed(spark, path)
    broken = sales(spark, ["a"]).withColumn("x", F.raise_error(F.lit("stop")))
    with pytest.raises(Exception, match="stop"):
        write_partitioned(broken, path, mode=mode)
    assert not is_committed(spark, path)
    write_partitioned(sales(spark, ["a"]), path, mode=mode)
    assert read_committed(spark, path, schemas.CLEAN_SALES).count() == 1


def test_written_rows_are_counted(spark, tmp_path):
    seen = Observation()
    write_partitioned(sales(spark, ["a", "b", "a"]), str(tmp_path / "o"), written=seen)
    assert seen.get == {"rows": 3}


def test_region_filter_prunes_folders(spark, tmp_path, plan):
    path = str(tmp_path / "out")
    write_partitioned(sales(spark, ["a", "b"]), path)
    df = read(spark, path).filter("region = 'a'").select("order_id", "revenue")
    text = plan(df)
    assert "PartitionFilters: [isnotnull(region" in text
    assert "ReadSchema: struct<order_id:string,revenue:double>" in text
    assert df.count() == 1


def test_drop_names_match_their_route(spark, tmp_path):
    from fnmatch import fnmatch

    at = datetime(2024, 1, 15, 12, 0, 0)
    df = spark.range(3)
    names = [
        os.path.basename(write_drop(df, d, str(tmp_path), at))
        for d in ("sales", "users", "transactions", "cdc_full")
    ]
    assert names[0] == "sales_20240115_120000.csv"
    assert all(fnmatch(n, pattern) for n, (pattern, _) in zip(names, ROUTES))
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        write_drop(df, "sales", str(tmp_path), at)


def test_csv_drop_keeps_awkward_text(spark, tmp_path, rows):
    texts = ['a "b"', "a,b", "back\\slash", '{"k": 1}', "x", None]
    data = [(str(i), t, *[None] * 7) for i, t in enumerate(texts)]
    df = files.inline_table(spark, data)
    path = write_drop(df, "sales", str(tmp_path), datetime(2024, 1, 1))
    assert rows(files.read_csv(spark, path)) == rows(df)


def test_catalog_table(spark, tmp_path, plan):
    path = str(tmp_path / "out")
    write_partitioned(sales(spark, ["a", "b", "a"]), path)
    catalog.register_table(spark, "sales_t", path, schemas.CLEAN_SALES, ["region"])
    df = spark.sql("SELECT order_id FROM sales_t WHERE region = 'a'")
    assert df.count() == 2
    assert "PartitionFilters: [isnotnull(region" in plan(df)
    write_partitioned(sales(spark, ["z"]), path)
    catalog.register_table(spark, "sales_t", path, schemas.CLEAN_SALES, ["region"])
    assert spark.table("sales_t").count() == 4


def test_sql_over_frames(spark):
    out = catalog.query(
        spark,
        "SELECT region, count(*) AS n FROM s GROUP BY region",
        {"s": sales(spark, ["a", "b", "a"])},
    )
    assert {r["region"]: r["n"] for r in out.collect()} == {"a": 2, "b": 1}


def test_registering_leaves_other_tables_alone(spark, tmp_path):
    path = str(tmp_path / "it's here")
    write_partitioned(sales(spark, ["a"]), path)
    sales(spark, ["x", "y"]).write.saveAsTable("mine")
    with pytest.raises(ValueError, match="mine"):
        catalog.register_table(spark, "mine", path, schemas.CLEAN_SALES, ["region"])
    assert spark.table("mine").count() == 2
    spark.sql("DROP TABLE mine")
    catalog.register_table(spark, "there", path, schemas.CLEAN_SALES, ["region"])
    with pytest.raises(ValueError, match="there"):
        catalog.register_table(spark, "there", str(tmp_path / "other"), schemas.CLEAN_SALES, ["region"])
    assert spark.table("there").count() == 1
    spark.sql("DROP TABLE there")


def test_sql_replaces_no_view(spark):
    spark.range(7).createOrReplaceTempView("s")
    views = len(spark.catalog.listTables())
    frames = {"s": sales(spark, ["a", "b"])}
    assert catalog.query(spark, "SELECT count(*) AS n FROM s", frames).first()["n"] == 2
    assert catalog.query(spark, "WITH t AS (SELECT * FROM s) SELECT count(*) AS n FROM t", frames).first()["n"] == 2
    assert spark.table("s").count() == 7
    assert len(spark.catalog.listTables()) == views
    spark.catalog.dropTempView("s")


def test_a_column_named_salt_stays(spark, tmp_path):
    other = spark.newSession()
    other.conf.set("spark.sql.adaptive.enabled", "false")
    df = other.range(500).selectExpr("if(id % 3 = 0, 'hot', cast(id as string)) as region", "id as salt", "id as _salt")
    path = str(tmp_path / "out")
    write_partitioned(df, path, policy=SkewPolicy(min_bytes=0, min_hits=10, cell_rows=10))
    found = spark.read.parquet(path)
    assert sorted(r["salt"] for r in found.collect()) == list(range(500))
    assert sorted(found.columns) == ["_salt", "region", "salt"]


def last_plan(spark):
    """The plan of the last SQL execution that ended."""
    store = spark._jsparkSession.sharedState().statusStore()
    return store.executionsList().last().physicalPlanDescription()


def test_local_layout_neither_shuffles_nor_sorts(spark, tmp_path, rows):
    path = str(tmp_path / "out")
    df = sales(spark, [f"r{i % 5}" for i in range(1000)]).repartition(3)
    df.write.parquet(str(tmp_path / "in"))
    df = spark.read.parquet(str(tmp_path / "in"))
    write_partitioned(df, path, layout="local")
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    assert "Exchange" not in last_plan(spark)
    assert "Sort" not in last_plan(spark)
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", "0") == "0"
    assert rows(read(spark, path), *df.columns) == rows(df)


def test_local_layout_with_more_values_than_open_files(spark, tmp_path, rows):
    path = str(tmp_path / "out")
    df = sales(spark, [f"r{i % 50}" for i in range(1000)]).coalesce(1)
    write_partitioned(df, path, layout="local")
    assert rows(read(spark, path), *df.columns) == rows(df)
    assert len(parquet_files(path)) == 50


def test_local_layout_keeps_the_callers_setting(spark, tmp_path):
    other = spark.newSession()
    other.conf.set("spark.sql.maxConcurrentOutputFileWriters", "3")
    write_partitioned(sales(other, ["a", "b"]), str(tmp_path / "out"), layout="local")
    assert other.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "3"


def test_json_landing_is_compressed(spark, tmp_path, monkeypatch):
    sf_dir = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
    monkeypatch.setattr(queries, "scratch_dir", lambda spark, label: str(tmp_path / label))
    queries.j1_json(spark, sf_dir)
    parts = [p for p in os.listdir(tmp_path / "landing-json" / "sales_1.json") if p.startswith("part-")]
    assert parts and all(p.endswith(".json.gz") for p in parts)
