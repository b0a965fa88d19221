"""One query per operator, each over whole tables of a star-schema folder."""

import time
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace import schemas
from millrace.functions import casts
from millrace.functions.routing import landing_prefix
from millrace.operators import cdc, clean, generate, marts, metrics, rollups
from millrace.plans import tables, temporal
from millrace.plans.pipeline import run_pipeline
from millrace.plans.simple_etl import run_simple_etl
from millrace.plans.tables import Landing
from millrace.session import scratch_dir
from millrace.sinks import catalog, partitioned
from millrace.sinks.formats import write_drop
from millrace.sources import files, landing
from millrace.streaming.changes import HistoryTables, apply_new_changes
from millrace.streaming.event_time import EventTables, event_totals, ingest_events
from millrace.streaming.incremental import ingest_new_files

SEED = 42

# Rows put beside the tables by the inline-table query.
INLINE_ROWS = [
    ("in-1", "Kite", "Toys", "4", "2.25", "9.00", "77", "2024-02-03T04:05:06Z", "ASIA"),
    (None, "Kite", "Toys", "1", "2.25", "2.25", "78", "2024-02-03T05:05:06Z", "ASIA"),
    ("in-2", "Drum", "Toys", "x", "8.50", "8.50", None, "2024-02-04T00:00:00Z", None),
]


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw sales as they land: text columns, from CSV."""
    return files.read_csv(spark, Landing.sales(spark, sf_dir))


# Sources


def s1_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(spark, sf_dir)


def s2_schema_tolerant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headers in another order, with blanks, in capitals, and without total_price."""
    raw = _raw(spark, sf_dir)
    day = F.coalesce(F.col("order_timestamp"), F.lit("~"))
    old, mid = day < "1998", (day >= "1994") & (day < "1998")
    folder = scratch_dir(spark, "drifted")
    reversed_columns = [F.col(c) for c in reversed(schemas.SALES_COLUMNS)]
    for part in (
        raw.filter(day < "1994").select(*reversed_columns),
        raw.filter(mid & (day < "1996")).toDF(*[f" {c}  " for c in schemas.SALES_COLUMNS]),
        raw.filter(mid & (day >= "1996")).toDF(*[c.upper() for c in schemas.SALES_COLUMNS]),
        raw.filter(~old).drop("total_price"),
    ):
        part.write.mode("append").option("header", True).option("escape", '"').csv(
            folder
        )
    return files.read_drifted(spark, folder)


def s3_inline_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    inline = files.inline_table(spark, INLINE_ROWS)
    return clean.clean_sales(inline.unionByName(_raw(spark, sf_dir)))


def _file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file name for each document: its source decides the dataset."""
    stems = F.array(*[F.lit(s) for s in ("sales_", "users_", "transactions_", "cdc_")])
    ends = F.array(*[F.lit(e) for e in (".csv", ".json", ".parquet", ".txt")])
    documents = tables.table(spark, sf_dir, "documents")
    return documents.select(
        "doc_id",
        F.concat(
            F.get(stems, (F.col("n_chars") % 4).cast("int")),
            F.col("lang"),
            F.get(ends, (F.length("source") % 4).cast("int")),
        ).alias("file_name"),
    )


def s4_route_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _file_names(spark, sf_dir).withColumn("prefix", landing_prefix("file_name"))


def s5_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land the orders as one drop per year and priority, then list the folder."""
    stems = {
        "1-URGENT": ("sales_", ".csv"),
        "2-HIGH": ("users_", ".json"),
        "3-MEDIUM": ("transactions_", ".parquet"),
        "5-LOW": ("cdc_", ".csv"),
    }
    stem, end = F.lit("notes_"), F.lit(".txt")
    for priority, (start, extension) in stems.items():
        chosen = F.col("o_orderpriority") == priority
        stem = F.when(chosen, start).otherwise(stem)
        end = F.when(chosen, extension).otherwise(end)
    folder = scratch_dir(spark, "drops")
    orders = tables.table(spark, sf_dir, "orders").select(
        F.concat(stem, F.year("o_orderdate").cast("string"), end).alias("drop"),
        F.col("o_orderkey").cast("string").alias("value"),
    )
    orders.write.partitionBy("drop").text(folder)
    listing = landing.list_landing(spark, folder).withColumn(
        "file_name", F.replace("file_name", F.lit("drop="))
    )
    return landing.manifest(listing, "/processed").select(
        "file_name", "prefix", "target"
    )


def s6_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.read_users(spark, Landing.users(spark, sf_dir))


def s7_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landing folder with two drops, and sales beside them."""
    folder = scratch_dir(spark, "transactions")
    payments = tables.transactions(spark, sf_dir)
    done = F.col("status") == "completed"
    for part, day in ((payments.filter(done), 15), (payments.filter(~done), 16)):
        write_drop(part, "transactions", folder, datetime(2024, 1, day))
    write_drop(files.inline_table(spark, INLINE_ROWS), "sales", folder, tables.STAMP)
    return files.read_transactions(spark, folder)


def s8_cdc_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "changes")
    log = tables.raw_changes(spark, sf_dir)
    return files.read_changes(spark, write_drop(log, "cdc_full", folder, tables.STAMP))


# Filters and projections


def f1_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.drop_null(_raw(spark, sf_dir))


def f2_partition_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = Landing.clean(spark, sf_dir)
    sales = partitioned.read_committed(spark, path, schemas.CLEAN_SALES)
    return sales.filter(F.col("region") == "EUROPE")


def p1_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replace a column in place and append one."""
    return _raw(spark, sf_dir).withColumns(
        {
            "category": F.lower("category"),
            "label": F.concat_ws("/", "region", "product_name"),
        }
    )


def p2_double(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(spark, sf_dir).select(
        "unit_price", casts.to_double("unit_price").alias("as_double")
    )


def p3_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(spark, sf_dir).select(
        "quantity", casts.to_int("quantity").alias("as_int")
    )


def p4_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(spark, sf_dir).select(
        "order_timestamp", casts.to_date("order_timestamp").alias("as_date")
    )


def p5_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(spark, sf_dir).select(
        "quantity",
        "unit_price",
        (casts.to_int("quantity") * casts.to_double("unit_price")).alias("revenue"),
    )


def p6_clean_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_sales(_raw(spark, sf_dir))


def p7_without_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_sales(
        _raw(spark, sf_dir), drop_source_total=True
    )


# Metrics and listings


def a1_row_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.row_metrics(_raw(spark, sf_dir))


def l1_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = clean.clean_sales(_raw(spark, sf_dir))
    return metrics.preview(sales, ordered=True)


def l2_schema_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types of the job's output, with how many values each column has."""
    sales = partitioned.read_committed(spark, Landing.clean(spark, sf_dir))
    return metrics.schema_report(sales).join(metrics.filled(sales), "column")


# Sinks


def k1_partition_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "partitioned")
    partitioned.write_partitioned(
        clean.clean_sales(_raw(spark, sf_dir)), path, layout="local"
    )
    return spark.read.schema(schemas.CLEAN_SALES).parquet(path)


def k2_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write twice, replacing folders; read only after both commits."""
    path = scratch_dir(spark, "committed")
    sales = clean.clean_sales(_raw(spark, sf_dir))
    for _ in range(2):
        partitioned.write_partitioned(sales, path, mode="overwrite", layout="local")
    return partitioned.read_committed(spark, path, schemas.CLEAN_SALES)


def k3_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales through CSV, users through JSON, payments through Parquet, joined."""
    folder = scratch_dir(spark, "formats")
    payments = files.read_transactions(
        spark,
        write_drop(
            tables.transactions(spark, sf_dir), "transactions", folder, tables.STAMP
        ),
    )
    users = files.read_users(
        spark, write_drop(tables.users(spark, sf_dir), "users", folder, tables.STAMP)
    )
    sales = files.read_csv(
        spark, write_drop(_raw(spark, sf_dir), "sales", folder, tables.STAMP)
    )
    lines = sales.groupBy("order_id").agg(F.count(F.lit(1)).alias("lines"))
    return (
        payments.join(users, "user_id")
        .join(lines, F.col("txn_id") == F.col("order_id"))
        .select("txn_id", "user_id", "amount", "status", "country", "is_active", "lines")
    )


def k4_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Register part of the regions, append the others, refresh, read all."""
    sales = clean.clean_sales(_raw(spark, sf_dir))
    first = F.coalesce(F.col("region").isin("ASIA", "EUROPE"), F.lit(False))
    path = scratch_dir(spark, "catalog")
    name = f"millrace_sales_{path.rpartition('-')[2]}"
    for part in (sales.filter(first), sales.filter(~first)):
        partitioned.write_partitioned(part, path, layout="local")
        catalog.register_table(spark, name, path, schemas.CLEAN_SALES, ["region"])
    return spark.table(name)


# Jobs


def j1_simple_etl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From a landing folder with two drops of sales, and one of users."""
    folder, path = scratch_dir(spark, "landing"), scratch_dir(spark, "simple-etl")
    raw = _raw(spark, sf_dir)
    old = F.coalesce(F.col("order_timestamp") < "1995", F.lit(False))
    write_drop(raw.filter(old), "sales", folder, datetime(2024, 1, 15))
    write_drop(raw.filter(~old), "sales", folder, datetime(2024, 1, 16))
    write_drop(tables.users(spark, sf_dir), "users", folder, datetime(2024, 1, 16))
    run_simple_etl(spark, folder, path)
    return partitioned.read_committed(spark, path, schemas.CLEAN_SALES)


def j1_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, path = scratch_dir(spark, "landing-json"), scratch_dir(spark, "simple-etl")
    _raw(spark, sf_dir).write.option("compression", "gzip").json(f"{folder}/sales_1.json")
    run_simple_etl(spark, folder, path, source_format="json")
    return partitioned.read_committed(spark, path, schemas.CLEAN_SALES)


def m1_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = run_pipeline(
        spark,
        Landing.sales(spark, sf_dir),
        Landing.users(spark, sf_dir),
        scratch_dir(spark, "pipeline"),
    )
    return _plain_sum(
        partitioned.read_committed(spark, paths["daily"], schemas.DAILY_REGION)
    )


def m2_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = Landing.clean(spark, sf_dir)
    sales = partitioned.read_committed(spark, path, schemas.CLEAN_SALES)
    return marts.enrich(sales, files.read_users(spark, Landing.users(spark, sf_dir)))


def m3_daily_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = Landing.clean(spark, sf_dir)
    sales = partitioned.read_committed(spark, path, schemas.CLEAN_SALES)
    return _plain_sum(marts.daily_region(sales))


def _plain_sum(daily: DataFrame) -> DataFrame:
    return daily.withColumn("revenue", F.col("revenue").cast("double"))


def q1_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = Landing.clean(spark, sf_dir)
    sales = partitioned.read_committed(spark, path, schemas.CLEAN_SALES)
    return catalog.query(
        spark,
        """
        SELECT u.country, s.category, count(*) AS orders, sum(s.quantity) AS units
        FROM sales s JOIN users u ON s.customer_id = u.user_id
        WHERE s.revenue >= 1000 AND u.is_active
        GROUP BY u.country, s.category
        """,
        {"sales": sales, "users": tables.users(spark, sf_dir)},
    )


# Changes


def c1_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first load and three runs over a growing folder of drops, the last one of old files.

    The first load is the sales job's.  The files of the third run have time stamps
    from ten days before the others, as restored or copied files do.
    """
    raw = _raw(spark, sf_dir)
    day = F.coalesce(F.col("order_timestamp"), F.lit(""))
    parts = [raw.filter((day >= low) & (day < high)) for low, high in (("", "1994"), ("1994", "1996"), ("1996", "1998"), ("1998", "~"))]
    base = scratch_dir(spark, "incremental")
    first = write_drop(parts[0], "sales", f"{base}/first", datetime(2024, 1, 14))
    run_simple_etl(spark, first, f"{base}/clean", batch="first")
    for number, part in enumerate(parts[1:], 1):
        drop = write_drop(part, "sales", f"{base}/landing", datetime(2024, 1, 14 + number))
        if number == 3:
            files.set_modified(spark, drop, time.time() - 10 * 24 * 3600)
        ingest_new_files(spark, f"{base}/landing", f"{base}/clean", f"{base}/checkpoint")
    return partitioned.read_committed(spark, f"{base}/clean", schemas.CLEAN_SALES)


def c2_current_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc.current_state(tables.changes(spark, sf_dir))


def c3_scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc.scd2_history(tables.changes(spark, sf_dir))


def c3_scd2_collapsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the sign of the value as attribute, so that neighbours often agree."""
    log = tables.changes(spark, sf_dir).withColumn("large", F.col("value") >= 50)
    return cdc.scd2_history(log.drop("value", "props"), collapse_unchanged=True)


def c4_scd2_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch whose changes are late: they fall between those already there."""
    log = tables.changes(spark, sf_dir)
    late = F.col("value") >= 80
    history = cdc.scd2_history(log.filter(~late))
    return cdc.scd2_incremental(history, log, log.filter(late))


def _change_file_history(spark: SparkSession, sf_dir: str, second) -> DataFrame:
    """Change files in two runs over a folder of drops, into a bucketed history; ``second`` picks those of the second run."""
    base = scratch_dir(spark, "history")
    history = HistoryTables(
        log=f"{base}/log",
        history=f"{base}/history",
        rejects=f"{base}/rejects",
        checkpoint=f"{base}/checkpoint",
        buckets=8,
    )
    log = tables.raw_changes(spark, sf_dir)
    for part, day in ((log.filter(~second), 15), (log.filter(second), 16)):
        write_drop(part, "cdc_full", f"{base}/landing", datetime(2024, 1, day))
        apply_new_changes(spark, f"{base}/landing", history)
    return partitioned.read_committed(spark, history.history, schemas.CHANGE_HISTORY).select(
        "order_id", "product_name", "category", "unit_price",
        "valid_from", "valid_to", "is_current",
    )


def c4_change_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second run's changes are late: they fall between those already there."""
    return _change_file_history(spark, sf_dir, F.col("unit_price").cast("decimal(14,2)") >= 80)


def c4_change_files_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second run's changes follow the first run's, so closed versions stay as they are."""
    return _change_file_history(spark, sf_dir, F.col("updated_at") >= "2024-01-24")


# Generators, one row per row of a given table


def _ids(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    return tables.table(spark, sf_dir, name).select(F.col(key).alias("id"))


def _buyers(spark: SparkSession, sf_dir: str) -> int:
    return tables.table(spark, sf_dir, "customer").count()


def g1_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = _ids(spark, sf_dir, "orders", "o_orderkey")
    return generate.sales(ids, SEED, users=_buyers(spark, sf_dir), null_rate=0.01)


def g2_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return generate.users(_ids(spark, sf_dir, "customer", "c_custkey"), SEED)


def g3_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = _ids(spark, sf_dir, "orders", "o_orderkey")
    return generate.transactions(ids, SEED, users=_buyers(spark, sf_dir))


def g4_changes_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = _ids(spark, sf_dir, "orders", "o_orderkey")
    return generate.changes(ids, "full", SEED, users=_buyers(spark, sf_dir))


def g4_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = _ids(spark, sf_dir, "events", "event_id")
    orders = tables.table(spark, sf_dir, "orders").count()
    buyers = _buyers(spark, sf_dir)
    return generate.changes(ids, "incremental", SEED, users=buyers, base_rows=orders)


# Event time


def e_event_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in three drops, the second one with late rows and copies, the third with copies of all purchases."""
    base = scratch_dir(spark, "events")
    rows = tables.table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("event_id"), F.col("user_id").cast("string").alias("user_id"), "event_type",
        F.concat(F.replace(F.col("ts").cast("string"), F.lit(" "), F.lit("T")), F.lit("Z")).alias("ts"),
        F.col("value").cast("decimal(18,2)").cast("string").alias("value"),
    )
    behind = F.col("event_type").isin("click", "view") & (F.col("ts") < "2024-01-20")
    early = F.col("ts") < "2024-01-16"
    drops = (rows.filter(early & ~behind), rows.filter(~early | behind).unionByName(rows.filter("event_type = 'error'")), rows.filter("event_type = 'purchase'"))
    held = EventTables(f"{base}/tables", delay="6 hours")
    for number, drop in enumerate(drops):
        drop.write.option("header", True).csv(f"{base}/landing/events_{number}.csv")
        ingest_events(spark, f"{base}/landing", held)
    return event_totals(spark, held, with_late=True).withColumn("value", F.col("value").cast("double"))


# Totals kept as partial results


def m3_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals by day, region and category from three batches, one of them put in again after a wrong try."""
    sales = clean.clean_sales(_raw(spark, sf_dir))
    path = scratch_dir(spark, "rollup")
    day = F.coalesce(F.col("order_date"), F.lit("1997-01-01").cast("date"))
    early, late = day < "1997-01-01", day >= "1999-06-01"
    rollups.add_sales(spark, sales.filter(early), path, "early")
    rollups.add_sales(spark, sales.filter(~early), path, "middle")
    rollups.add_sales(spark, sales.filter(late), path, "late")
    rollups.add_sales(spark, sales.filter(~early & ~late), path, "middle")
    return rollups.read_totals(spark, path).withColumn("revenue", F.col("revenue").cast("double"))


def m3_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Buyers and median revenue by month, from merged daily sketches, beside the exact numbers.

    ``buyers_near``: within 5 %.  ``median_near``: of the sales 45 % at least lie up to the estimate, 55 % at most below.
    """
    sales = clean.clean_sales(_raw(spark, sf_dir))
    days = sketch_table(rollups.sketch_days(sales))
    month = rollups.month_of("order_date").alias("month")
    found = rollups.sketch_estimates(rollups.merge_sketches(days, month))
    exact = sales.select(month, "customer_id", "revenue").join(found.select("month", F.col("revenue").alias("median")), "month")
    exact = exact.groupBy("month").agg(
        F.count_distinct("customer_id").alias("exact"),
        (F.count_if(F.col("revenue") <= F.col("median")) >= 0.45 * F.count("revenue")).alias("above"),
        (F.count_if(F.col("revenue") < F.col("median")) <= 0.55 * F.count("revenue")).alias("below"),
    )
    near = F.abs(F.col("buyers") - F.col("exact")) <= 0.05 * F.col("exact")
    return exact.join(found, "month").select("month", F.col("exact").alias("buyers"), near.alias("buyers_near"), (F.col("above") & F.col("below")).alias("median_near"))


def sketch_table(days: DataFrame) -> DataFrame:
    """Daily sketches written and read again, as a job of another day would find them."""
    path = scratch_dir(days.sparkSession, "sketches")
    days.write.parquet(path)
    return days.sparkSession.read.parquet(path)


QUERIES = {
    query.__name__: query
    for query in (
        s1_csv_scan,
        s2_schema_tolerant,
        s3_inline_table,
        s4_route_files,
        s5_manifest,
        s6_json,
        s7_parquet,
        s8_cdc_csv,
        f1_not_null,
        f2_partition_read,
        p1_columns,
        p2_double,
        p3_int,
        p4_date,
        p5_revenue,
        p6_clean_sales,
        p7_without_total,
        a1_row_metrics,
        l1_preview,
        l2_schema_report,
        k1_partition_roundtrip,
        k2_commit,
        k3_formats,
        k4_catalog,
        j1_simple_etl,
        j1_json,
        g1_sales,
        g2_users,
        g3_transactions,
        g4_changes_full,
        g4_changes,
        c1_incremental,
        c2_current_state,
        c3_scd2,
        c3_scd2_collapsed,
        c4_scd2_incremental,
        c4_change_files,
        c4_change_files_in_order,
        m1_pipeline,
        m2_enrich,
        m3_daily_region,
        e_event_totals,
        m3_rollup,
        m3_sketches,
        q1_sql,
    )
} | temporal.QUERIES
