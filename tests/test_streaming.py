import os
import random
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from millrace import schemas
from millrace.operators import cdc, generate
from millrace.operators.clean import clean_sales
from millrace.operators.skew import SkewPolicy
from millrace.plans.simple_etl import run_simple_etl
from millrace.sinks.formats import write_drop
from millrace.sinks.partitioned import read_committed
from millrace.sources.files import read_changes, read_csv
from millrace.streaming import changes as changes_module
from millrace.streaming.changes import HistoryTables, apply_new_changes, compact_log, rebuild_buckets
from millrace.streaming.incremental import ingest_new_files


@pytest.mark.parametrize("max_files", [None, 1])
def test_each_file_once(spark, tmp_path, rows, max_files):
    landing, out, checkpoint = (str(tmp_path / n) for n in ("landing", "out", "check"))

    def run():
        ingest_new_files(
            spark, f"{landing}/sales_*.csv", out, checkpoint, max_files=max_files
        )
        return spark.read.schema(schemas.CLEAN_SALES).parquet(out)

    sales = generate.sales(spark.range(300).repartition(3), null_rate=0.1)
    write_drop(sales, "sales", landing, datetime(2024, 1, 1))
    first = run().count()
    assert 0 < first < 300
    assert run().count() == first
    more = generate.sales(spark.range(300, 350))
    write_drop(more, "sales", landing, datetime(2024, 1, 2))
    final = run()
    expected = clean_sales(read_csv(spark, f"{landing}/sales_*.csv"))
    assert rows(final, *expected.columns) == rows(expected)
    assert final.count() == first + 50


def test_a_rewritten_file_is_not_read_again(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "check")
    for order in ("1", "2"):
        (folder / "sales_1.csv").write_text(
            ",".join(schemas.SALES_COLUMNS) + f"\n{order},p,c,1,1,1,u,t,r\n"
        )
        ingest_new_files(spark, str(folder), out, checkpoint)
    assert [r["order_id"] for r in spark.read.parquet(out).collect()] == ["1"]


def sales_file(folder, name, order, age_days=0):
    folder.mkdir(exist_ok=True)
    file = folder / name
    file.write_text(",".join(schemas.SALES_COLUMNS) + f"\n{order},p,c,1,1,1,u,t,r\n")
    at = time.time() - age_days * 86400
    os.utime(file, (at, at))


def test_old_files_are_not_skipped(spark, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "check")
    for run, age in enumerate((0, 10, 400)):
        sales_file(tmp_path / "in", f"sales_{run}.csv", run, age)
        ingest_new_files(spark, str(tmp_path / "in"), out, checkpoint)
        assert read_committed(spark, out, schemas.CLEAN_SALES).count() == run + 1


def test_rows_of_the_sales_job_stay_visible(spark, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "check")
    sales_file(tmp_path / "first", "sales_0.csv", "a")
    run_simple_etl(spark, str(tmp_path / "first"), out, batch="first")
    sales_file(tmp_path / "in", "sales_1.csv", "b")
    ingest_new_files(spark, str(tmp_path / "in"), out, checkpoint)
    sales_file(tmp_path / "more", "sales_2.csv", "c")
    ingest_new_files(spark, str(tmp_path / "more"), out, str(tmp_path / "other-check"))
    found = read_committed(spark, out, schemas.CLEAN_SALES)
    assert sorted(r["order_id"] for r in found.collect()) == ["a", "b", "c"]
    assert set(found.columns) == set(schemas.CLEAN_SALES.names)


@pytest.mark.parametrize("by", [["region"], []])
def test_another_layout_is_refused(spark, tmp_path, by):
    out = str(tmp_path / "out")
    sales_file(tmp_path / "in", "sales_0.csv", "a")
    clean_sales(read_csv(spark, str(tmp_path / "in"))).write.partitionBy(*by).parquet(out)
    with pytest.raises(ValueError, match="batch_id|partitioned"):
        ingest_new_files(spark, str(tmp_path / "in"), out, str(tmp_path / "check"))
    assert spark.read.parquet(out).count() == 1


def test_json_files_and_an_archive(spark, tmp_path):
    out, checkpoint, done = (str(tmp_path / n) for n in ("out", "check", "done"))
    (tmp_path / "in").mkdir()
    for run in range(3):
        (tmp_path / "in" / f"sales_{run}.json").write_text(f'{{"order_id": {run}, "region": "r"}}\n')
        ingest_new_files(spark, str(tmp_path / "in"), out, checkpoint, source_format="json", archive_path=done)
    found = read_committed(spark, out, schemas.CLEAN_SALES)
    assert sorted(r["order_id"] for r in found.collect()) == ["0", "1", "2"]


@pytest.fixture
def tables(tmp_path):
    return HistoryTables(
        log=str(tmp_path / "log"),
        history=str(tmp_path / "history"),
        rejects=str(tmp_path / "rejects"),
        checkpoint=str(tmp_path / "check"),
        buckets=4,
    )


COLUMNS = ["order_id", "quantity", "valid_from", "valid_to", "is_current"]


def test_history_from_change_files(spark, tmp_path, tables, rows):
    landing = str(tmp_path / "landing")
    full = generate.changes(spark.range(100), "full")
    later = generate.changes(spark.range(400), "incremental", base_rows=100)
    newest = later.filter("updated_at >= '2025-01-15'")
    late = later.filter("updated_at < '2025-01-15'")
    for day, part in enumerate((full, newest, late), 1):
        write_drop(part, "cdc_full", landing, datetime(2024, 1, day))
        apply_new_changes(spark, f"{landing}/cdc_*.csv", tables)
    log = cdc.usable(cdc.check_changes(read_changes(spark, f"{landing}/cdc_*.csv")))
    whole = cdc.scd2_history(log, tie=["customer_id"])
    history = spark.read.parquet(tables.history)
    assert rows(history, *COLUMNS) == rows(whole, *COLUMNS)
    apply_new_changes(spark, f"{landing}/cdc_*.csv", tables)
    assert rows(spark.read.parquet(tables.history), *COLUMNS) == rows(whole, *COLUMNS)


HEADER = ",".join(schemas.CHANGE_COLUMNS)


def write_changes(folder, name, *changes):
    folder.mkdir(exist_ok=True)
    lines = [f"{k},p,c,{q},1.0,1.0,u,t,r,{op},{at}" for k, op, at, q in changes]
    (folder / name).write_text("\n".join([HEADER, *lines]) + "\n")


def test_order_in_the_file_breaks_ties_and_bad_rows_are_set_aside(spark, tmp_path, tables):
    folder = tmp_path / "in"
    t = "2024-01-01T00:00:00Z"
    write_changes(
        folder, "cdc_1.csv",
        ("a", "INSERT", t, 1), ("a", "UPDATE", t, 2), ("b", "MERGE", t, 1), ("", "INSERT", t, 1),
    )
    apply_new_changes(spark, str(folder), tables)
    (row,) = spark.read.parquet(tables.history).collect()
    assert (row["order_id"], row["quantity"]) == ("a", "2")
    write_changes(folder, "cdc_2.csv", ("a", "UPDATE", t, 3))
    apply_new_changes(spark, str(folder), tables)
    (row,) = spark.read.parquet(tables.history).collect()
    assert row["quantity"] == "3"
    reasons = {r["reject_reason"] for r in spark.read.parquet(tables.rejects).collect()}
    assert reasons == {"missing key", "unknown operation"}


def test_a_key_whose_only_version_vanishes(spark, tmp_path, tables):
    folder = tmp_path / "in"
    t = "2024-01-01T00:00:00Z"
    write_changes(folder, "cdc_1.csv", ("a", "INSERT", t, 1), ("zz", "INSERT", t, 1))
    apply_new_changes(spark, str(folder), tables)
    write_changes(folder, "cdc_2.csv", ("a", "DELETE", t, 1))
    apply_new_changes(spark, str(folder), tables)
    left = spark.read.schema(schemas.CHANGE_HISTORY).parquet(tables.history).filter("is_current")
    assert [r["order_id"] for r in left.collect()] == ["zz"]


def test_heavy_keys_in_change_files(spark, tmp_path, tables, rows):
    """A key with most of the changes, many of them at one instant."""
    changes = []
    for i in range(300):
        key = "hot" if i % 3 else f"k{i % 20}"
        second = 7 if i % 4 == 0 else i % 50
        changes.append(
            (key, ("UPDATE", "DELETE")[i % 7 == 0], f"2024-01-01T00:00:{second:02}Z", i)
        )
    folder = tmp_path / "in"
    write_changes(folder, "cdc_1.csv", *changes[:200])
    write_changes(folder, "cdc_2.csv", *changes[200:])
    policy = SkewPolicy(min_bytes=0, min_hits=10, cell_rows=10)
    apply_new_changes(spark, str(folder), tables, policy=policy)
    history = rows(spark.read.parquet(tables.history), *COLUMNS)
    rebuild_buckets(spark, tables, range(4))
    assert rows(spark.read.parquet(tables.history), *COLUMNS) == history
    assert len(history) > 40


def test_only_touched_buckets_are_rewritten(spark, tmp_path, tables):
    folder = tmp_path / "in"
    t = "2024-01-01T00:00:00Z"
    write_changes(folder, "cdc_1.csv", *[(f"k{i}", "INSERT", t, 1) for i in range(40)])
    apply_new_changes(spark, str(folder), tables)
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "history").rglob("*.parquet")}
    assert len({p.parent for p in files}) == 4
    write_changes(folder, "cdc_2.csv", ("k7", "DELETE", "2024-02-01T00:00:00Z", 1))
    apply_new_changes(spark, str(folder), tables)
    kept = [p for p, at in files.items() if p.exists() and p.stat().st_mtime_ns == at]
    assert len({p.parent for p in kept}) == 3


def test_rebuilding_is_idempotent(spark, tmp_path, tables, rows):
    folder = tmp_path / "in"
    t = "2024-01-01T00:00:00Z"
    write_changes(folder, "cdc_1.csv", *[(f"k{i}", "INSERT", t, 1) for i in range(9)])
    apply_new_changes(spark, str(folder), tables)
    before = rows(spark.read.parquet(tables.history), *COLUMNS)
    rebuild_buckets(spark, tables, [0, 1, 2, 3])
    assert rows(spark.read.parquet(tables.history), *COLUMNS) == before


def test_batches_without_usable_changes(spark, tmp_path, tables):
    folder = tmp_path / "in"
    write_changes(folder, "cdc_1.csv", ("a", "MERGE", "2024-01-01T00:00:00Z", 1))
    apply_new_changes(spark, str(folder), tables)
    write_changes(folder, "cdc_2.csv")
    apply_new_changes(spark, str(folder), tables)
    assert spark.read.parquet(tables.rejects).count() == 1
    assert not (tmp_path / "history").exists()
    write_changes(folder, "cdc_3.csv", ("a", "UPDATE", "2024-01-01T00:00:00Z", 1))
    apply_new_changes(spark, str(folder), tables)
    assert spark.read.parquet(tables.history).count() == 1


def test_an_in_order_batch_leaves_closed_files_alone(spark, tmp_path, tables):
    folder = tmp_path / "in"
    for day in (1, 2):
        write_changes(folder, f"cdc_{day}.csv", *[(f"k{i}", "UPDATE", f"2024-01-0{day}T00:00:00Z", day) for i in range(300)])
        apply_new_changes(spark, str(folder), tables)
    closed = {p: p.stat().st_mtime_ns for p in (tmp_path / "history" / "part=closed").rglob("*.parquet")}
    assert closed
    write_changes(folder, "cdc_3.csv", *[(f"k{i}", "UPDATE", "2024-01-03T00:00:00Z", 3) for i in range(200)])
    apply_new_changes(spark, str(folder), tables)
    assert all(p.exists() and p.stat().st_mtime_ns == at for p, at in closed.items())
    history = read_committed(spark, tables.history, schemas.CHANGE_HISTORY)
    assert history.filter("is_current").count() == 300
    assert history.filter("not is_current").count() == 500


KEYS = [f"k{i}" for i in range(7)]


@pytest.mark.parametrize("seed", range(4))
def test_any_batches_give_the_whole_history(spark, tmp_path, tables, rows, seed):
    """In order, late, at equal times, deletes of deleted keys; some batches tried again."""
    rng = random.Random(seed)
    folder = tmp_path / "in"
    for run in range(4):
        late = run == 2
        changes = [
            (rng.choice(KEYS), rng.choice(["INSERT", "UPDATE", "DELETE"]),
             f"2024-01-01T00:{0 if late else 10 * run:02}:{rng.randrange(8):02}Z", 100 * run + i)
            for i in range(12)
        ]
        write_changes(folder, f"cdc_{run}.csv", *changes)
        if run % 2:
            _fail_after(spark, folder, tables, rng.choice(["write", "state", "drop"]))
        apply_new_changes(spark, str(folder), tables)
        if run == 2:
            compact_log(spark, tables, batches=1)
        log = cdc.usable(cdc.check_changes(read_changes(spark, str(folder)).withColumn("quantity_", F.col("quantity").cast("int"))))
        whole = cdc.scd2_history(log, tie=["quantity_"])
        found = read_committed(spark, tables.history, schemas.CHANGE_HISTORY)
        assert rows(found, *COLUMNS) == rows(whole, *COLUMNS)


def _fail_after(spark, folder, tables, step):
    """Run the new batch up to a step, then fail as a lost driver would."""
    names = {"write": "write_partitioned", "state": "_drop_others", "drop": "set_marker"}
    original, seen = getattr(changes_module, names[step]), []

    def stop(*args, **options):
        if step == "write" and len(seen) < 2:
            seen.append(1)
            return original(*args, **options)
        raise RuntimeError("lost")

    setattr(changes_module, names[step], stop)
    try:
        with pytest.raises(Exception, match="lost"):
            apply_new_changes(spark, str(folder), tables)
    finally:
        setattr(changes_module, names[step], original)


def test_compaction(spark, tmp_path, tables, rows):
    folder = tmp_path / "in"
    for day in range(1, 5):
        write_changes(folder, f"cdc_{day}.csv", *[(f"k{i}", "UPDATE", f"2024-01-0{day}T00:00:00Z", day) for i in range(20)])
        apply_new_changes(spark, str(folder), tables)
    before = rows(spark.read.parquet(tables.history), *COLUMNS)
    assert compact_log(spark, tables, batches=4) == []
    assert compact_log(spark, tables, batches=3) == [0, 1, 2, 3]
    assert len(list((tmp_path / "log").rglob("batch_id=*"))) == 4
    rebuild_buckets(spark, tables, range(4))
    assert rows(spark.read.parquet(tables.history), *COLUMNS) == before
    write_changes(folder, "cdc_9.csv", ("k1", "DELETE", "2023-01-01T00:00:00Z", 0), ("k1", "UPDATE", "2024-01-02T12:00:00Z", 9))
    apply_new_changes(spark, str(folder), tables)
    assert len(rows(spark.read.parquet(tables.history), *COLUMNS)) == len(before) + 1


def test_a_folder_of_drops_is_read_as_the_batch_reader_does(spark, tmp_path, rows):
    """Drops below the folder, files of other formats beside them, later drops in a later run."""
    land, out, checkpoint = str(tmp_path / "land"), str(tmp_path / "out"), str(tmp_path / "check")
    sales = generate.sales(spark.range(60))
    for day, low in ((1, 0), (2, 20), (3, 40)):
        part = generate.sales(spark.range(low, low + 20))
        write_drop(part, "sales", f"{land}/2024", datetime(2024, 1, day))
        if day == 2:
            write_drop(generate.users(spark.range(3)), "users", land, datetime(2024, 1, 2))
        if day > 1:
            ingest_new_files(spark, land, out, checkpoint)
    expected = clean_sales(read_csv(spark, land, glob="*.csv*"))
    found = spark.read.schema(schemas.CLEAN_SALES).parquet(out)
    assert found.count() == 60 == sales.count()
    assert rows(found, *expected.columns) == rows(expected)


def test_nothing_to_read_is_an_error(spark, tmp_path):
    empty = tmp_path / "empty"
    empty.mkdir()
    (empty / "_SUCCESS").write_text("")
    (empty / "users.json").write_text("{}")
    for path in (str(empty), f"{empty}/sales_*.csv"):
        with pytest.raises(FileNotFoundError):
            ingest_new_files(spark, path, str(tmp_path / "out"), str(tmp_path / "check"))
