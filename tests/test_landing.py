from fnmatch import fnmatchcase

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from millrace.functions.routing import ROUTES, landing_prefix
from millrace.sources.landing import list_landing, manifest

PREFIXES = {
    "sales_20240115_120000.csv": "sales/",
    "users_20240115_120001.json": "users/",
    "transactions_20240115_120002.parquet": "transactions/",
    "cdc_full_20240115_120003.csv": "cdc/",
    "sales_.csv": "sales/",
    "sales.csv": None,
    "sales_1.json": None,
    "my_sales_1.csv": None,
    "SALES_1.csv": None,
    "notes.txt": None,
}


def routed(spark, names):
    df = spark.createDataFrame([(n,) for n in names], "name string")
    return [r[0] for r in df.select(landing_prefix("name")).collect()]


def test_known_names(spark):
    assert routed(spark, PREFIXES) == list(PREFIXES.values())
    assert routed(spark, [None]) == [None]


PIECES = st.sampled_from(
    ["sales_", "users_", "cdc_", "transactions_", "sales", ".csv", ".json", ".parquet", "x", "\n", "*"]
)


@settings(
    max_examples=10,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(names=st.lists(st.lists(PIECES, max_size=4).map("".join), min_size=30, max_size=60))
def test_routing_is_shell_matching(spark, names):
    expected = [
        next((prefix for pattern, prefix in ROUTES if fnmatchcase(n, pattern)), None)
        for n in names
    ]
    assert routed(spark, names) == expected


def test_manifest_of_files_and_drops(spark, tmp_path, plan):
    (tmp_path / "users_1.json").write_text("{}\n")
    (tmp_path / "notes.txt").write_text("x")
    (tmp_path / "old").mkdir()
    (tmp_path / "old" / "sales_0.csv").write_text("x")
    spark.range(10).repartition(2).write.csv(str(tmp_path / "sales_1.csv"))
    listing = list_landing(spark, str(tmp_path))
    out = manifest(listing, "/lake/").collect()
    assert [(r["file_name"], r["target"], r["parts"]) for r in out] == [
        ("sales_1.csv", "/lake/sales/sales_1.csv", 2),
        ("users_1.json", "/lake/users/users_1.json", 1),
    ]
    assert out[1]["length"] == 3
    assert "content" not in plan(listing).split("ReadSchema")[1].splitlines()[0]


def test_empty_files_are_listed(spark, tmp_path):
    for name, text in (("sales_1.csv", "x"), ("sales_2.csv", ""), ("users_1.json", ""), ("_SUCCESS", ""), (".hidden", "")):
        (tmp_path / name).write_text(text)
    found = manifest(list_landing(spark, str(tmp_path)), "/t").collect()
    assert [(r["file_name"], r["parts"], r["length"]) for r in found] == [
        ("sales_1.csv", 1, 1), ("sales_2.csv", 1, 0), ("users_1.json", 1, 0),
    ]


@pytest.mark.parametrize("target", ["/out", "/out/"])
def test_missing_folder_is_empty(spark, tmp_path, target):
    assert manifest(list_landing(spark, str(tmp_path / "nowhere")), target).count() == 0
