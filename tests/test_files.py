import gzip
from datetime import datetime

import pytest

from millrace import schemas
from millrace.operators import generate
from millrace.sinks.formats import write_drop
from millrace.sources import files

HEADER = ",".join(schemas.SALES_COLUMNS)


@pytest.fixture
def folder(tmp_path):
    """Write text files; a name may hold blanks and percent signs."""
    base = tmp_path / "land ing"
    base.mkdir()

    def write(**texts):
        for name, text in texts.items():
            (base / name.replace("__", ".")).write_text(text)
        return str(base)

    return write


def line(order_id="1", product="Pen", region="us-east"):
    return f"{order_id},{product},Office,2,1.50,3.00,c1,2024-01-15T10:30:00Z,{region}"


def test_all_files_of_a_folder(spark, folder):
    path = folder(
        a__csv=f"{HEADER}\n{line('1')}\n{line('2')}\n", b__csv=f"{HEADER}\n{line('3')}\n"
    )
    df = files.read_csv(spark, path)
    assert df.schema == schemas.RAW_SALES
    assert sorted(r["order_id"] for r in df.collect()) == ["1", "2", "3"]


def test_glob_and_recursion(spark, folder, tmp_path):
    path = folder(a__csv=f"{HEADER}\n{line('1')}\n", b__txt=f"{HEADER}\n{line('2')}\n")
    assert files.read_csv(spark, path, glob="*.csv").count() == 1
    assert files.read_csv(spark, str(tmp_path), recursive=True).count() == 2


@pytest.mark.parametrize("cell", ["", '""'])
def test_empty_id_is_null(spark, folder, cell):
    path = folder(a__csv=f"{HEADER}\n{line(cell)}\n")
    assert files.read_csv(spark, path).first()["order_id"] is None


def test_row_shapes(spark, folder):
    rows = [
        line("short").rsplit(",", 3)[0],
        line("long") + ",surplus",
        line("comma", '"a, b"'),
        line("quote", '"say ""hi"""'),
    ]
    path = folder(a__csv="\n".join([HEADER, *rows]) + "\n")
    out = {r["order_id"]: r for r in files.read_csv(spark, path).collect()}
    assert out["short"]["region"] is None
    assert out["long"]["region"] == "us-east"
    assert out["comma"]["product_name"] == "a, b"
    assert out["quote"]["product_name"] == 'say "hi"'


def test_line_breaks_need_multiline(spark, folder):
    product = '"two\nlines"'
    path = folder(a__csv=f"{HEADER}\n{line('1', product)}\n")
    row = files.read_csv(spark, path, multiline=True).first()
    assert row["product_name"] == "two\nlines"


@pytest.mark.parametrize(
    "header",
    [
        HEADER.replace("order_id,product_name", "product_name,order_id"),
        HEADER + ",more",
        HEADER.replace(",region", ""),
    ],
)
def test_strict_reader_rejects_other_headers(spark, folder, header):
    path = folder(a__csv=f"{HEADER}\n{line()}\n", b__csv=f"{header}\n{line()}\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.read_csv(spark, path).collect()


def test_drifted_headers(spark, folder, rows):
    path = folder(**{
        "plain__csv": f"{HEADER}\n{line('1')}\n",
        "second one__csv": f"{HEADER}\n{line('2')}\n",
        "swapped__csv": "region,order_id\neu-west,3\n",
        "extra%20__csv": 'colour,"order_id"\nred,4\nblue,5\n',
        "foreign__csv": "x,y\n1,2\n3,4\n",
        "empty__csv": "",
        "late__csv": "\n \t \nquantity,order_id\n9,6\n",
    })
    with pytest.raises(ValueError, match="foreign.csv"):
        files.read_drifted(spark, path)
    df = files.read_drifted(spark, path, set_aside=True)
    assert df.columns == list(schemas.SALES_COLUMNS)
    assert rows(df, "order_id", "region", "category") == [
        ("1", "us-east", "Office"),
        ("2", "us-east", "Office"),
        ("3", "eu-west", None),
        ("4", None, None),
        ("5", None, None),
        ("6", None, None),
    ]
    left = files.unrecognised(files.csv_headers(spark, path)).collect()
    assert [(r["path"].rpartition("/")[2], r["header"]) for r in left] == [("foreign.csv", "x,y")]


def test_headers_with_blanks_and_capitals(spark, folder, rows):
    path = folder(**{
        "a__csv": "order_id , product_name ,region\n1, Pen ,eu\n2,  ,\n",
        "b__csv": 'ORDER_ID,Region,"PRODUCT_NAME"\n3,us,Cup\n',
        "c__csv": "\ufeffRegion,order_id,ORDER_ID\r\nus,4,5\r\n",
    })
    df = files.read_drifted(spark, path)
    assert rows(df, "order_id", "product_name", "region") == [
        ("1", "Pen", "eu"), ("2", None, None), ("3", "Cup", "us"), ("4", None, "us"),
    ]


def test_no_file_is_an_error(spark, tmp_path):
    (tmp_path / "empty" / "below").mkdir(parents=True)
    (tmp_path / "empty" / "notes.txt").write_text("x")
    for read in (files.read_csv, files.read_sales_json, files.read_drifted):
        with pytest.raises(FileNotFoundError):
            read(spark, str(tmp_path / "empty"), glob="*.csv")
    with pytest.raises(FileNotFoundError):
        files.read_users(spark, str(tmp_path / "empty"))


def test_headers_of_odd_files(spark, folder):
    """Longer than one read, after blank lines, compressed, without a line."""
    body = "\n".join(line(str(i)) for i in range(60_000))
    wide = HEADER + "," + ",".join(f"more{i}" for i in range(3000))
    path = folder(a__csv=f"{HEADER}\n{body}\n", b__csv=f"\n\n{wide}\r\n{body}\n", c__csv="", d__csv=HEADER)
    with gzip.open(f"{path}/e.csv.gz", "wt") as file:
        file.write(f"{HEADER}\n{body}\n")
    found = {r["path"].rpartition("/")[2]: r["header"] for r in files.csv_headers(spark, path).collect()}
    assert found == {"a.csv": HEADER, "b.csv": wide, "d.csv": HEADER, "e.csv.gz": HEADER}


def test_headers_take_few_bytes(spark, folder):
    """Bytes that Spark's file system has read, against the size of the file."""
    body = "\n".join(line(str(i)) for i in range(60_000))
    path = folder(a__csv=f"{HEADER}\n{body}\n", b__csv=f"{HEADER},more\n{body}\n")
    statistics = spark.sparkContext._jvm.org.apache.hadoop.fs.FileSystem.getGlobalStorageStatistics().get("file")
    before = statistics.getLong("bytesRead")
    assert files.csv_headers(spark, path).count() == 2
    assert statistics.getLong("bytesRead") - before < len(body) / 10


def test_drifted_reader_on_one_header_reads_the_folder(spark, folder, rows, plan):
    path = folder(a__csv=f"{HEADER}\n{line('1')}\n", b__csv=f"{HEADER}\n{line('2')}\n")
    assert rows(files.read_drifted(spark, path)) == rows(files.read_csv(spark, path))


def test_a_data_line_that_looks_like_a_header(spark, folder):
    path = folder(a__csv=f"{HEADER}\n{line('1', 'region', 'order_id')}\n{line('2')}\n")
    assert files.read_drifted(spark, path).count() == 2


def test_drift_with_stored_headers(spark, folder, rows, tmp_path):
    path = folder(a__csv=f"{HEADER}\n{line('1')}\n", b__csv="order_id\n2\n")
    stored = str(tmp_path / "headers")
    files.csv_headers(spark, path).write.parquet(stored)
    headers = spark.read.parquet(stored)
    again = files.read_drifted(spark, path, headers=headers)
    assert rows(again) == rows(files.read_drifted(spark, path))


def test_header_of_a_file_in_many_splits(spark, folder):
    body = "\n".join(line(str(i)) for i in range(5000))
    path = folder(a__csv=f"{HEADER}\n{body}\n", b__csv=f"{HEADER},more\n{body}\n")
    other = spark.newSession()
    other.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    other.conf.set("spark.sql.files.openCostInBytes", "1k")
    assert other.read.text(path).rdd.getNumPartitions() > 10
    headers = {r["header"] for r in files.csv_headers(other, path).collect()}
    assert headers == {HEADER, f"{HEADER},more"}
    assert files.read_drifted(other, path).count() == 10_000


def test_scan_reads_only_the_columns_used(spark, folder, plan):
    path = folder(a__csv=f"{HEADER}\n{line()}\n")
    text = plan(files.read_csv(spark, path).filter("order_id is not null").select("region"))
    assert "ReadSchema: struct<order_id:string,region:string>" in text
    assert "IsNotNull(order_id)" in text


def test_users_json(spark, folder):
    path = folder(a__json='{"user_id":"u1","is_active":true,"other":1}\n{"user_id":"u2"}\n')
    df = files.read_users(spark, path)
    assert df.schema == schemas.USERS
    found = {r["user_id"]: r["is_active"] for r in df.collect()}
    assert found == {"u1": True, "u2": None}


def test_changes_csv(spark, folder):
    path = folder(a__csv=f"{HEADER},operation,updated_at\n{line()},INSERT,2024-01-15T11:00:00Z\n")
    row = files.read_changes(spark, path).first()
    assert (row["operation"], row["updated_at"]) == ("INSERT", "2024-01-15T11:00:00Z")


def test_parquet_drops_below_a_folder(spark, tmp_path):
    payments = generate.transactions(spark.range(8), users=4)
    for day in (1, 2):
        write_drop(payments, "transactions", str(tmp_path / "land"), datetime(2024, 1, day))
    assert files.read_transactions(spark, str(tmp_path / "land")).count() == 16
    (tmp_path / "empty").mkdir()
    with pytest.raises(FileNotFoundError):
        files.read_transactions(spark, str(tmp_path / "empty"))


def test_listing(spark, tmp_path):
    (tmp_path / "a" / "_hidden").mkdir(parents=True)
    for name in ("a/x.csv", "a/_hidden/y.csv", "a/.z.csv", "b.csv", "c.json"):
        (tmp_path / name).write_text("1")
    names = lambda *args: sorted(s.getPath().getName() for s in files.list_files(spark, *args))
    assert names(str(tmp_path)) == ["b.csv", "c.json", "x.csv"]
    assert names(str(tmp_path), "*.csv*") == ["b.csv", "x.csv"]
    assert names(f"{tmp_path}/*.json") == ["c.json"]
    before = files.listing_digest(spark, str(tmp_path))
    assert before == files.listing_digest(spark, str(tmp_path)) and before.startswith("3 files")
    (tmp_path / "b.csv").write_text("22")
    assert files.listing_digest(spark, str(tmp_path)) != before
