"""The sales job: CSV or JSON in, clean, region-partitioned Parquet out."""

from pyspark.sql import Observation, SparkSession, functions as F, types as T

from millrace import schemas
from millrace.operators.clean import clean_sales
from millrace.operators.metrics import counted, observed
from millrace.sinks.catalog import register_table
from millrace.sinks.partitioned import BATCH, drop_batch, write_partitioned
from millrace.sources.files import FILES, is_file, read_csv, read_drifted, read_sales_json


def run_simple_etl(
    spark: SparkSession,
    source_path: str,
    output_path: str,
    mode: str = "append",
    layout: str = "local",
    drifted: bool = False,
    multiline: bool = False,
    drop_source_total: bool = False,
    metrics: bool = True,
    exact_counts: bool = False,
    source_format: str = "csv",
    glob: str | None = None,
    recursive: bool = True,
    batch: str | None = None,
    table: str | None = None,
) -> dict:
    """Run the job in one scan and one write; returns its row counts.

    Regions are few, so the default ``layout`` writes them without a shuffle.

    ``source_path`` is a file, a drop or a folder of them; of a folder only files of
    the ``source_format`` count, or those that ``glob`` names.  ``rows_written`` is
    counted in the writing stage and exact.  ``rows_read`` is counted in the scan
    and may be high after a lost executor, which ``rows_read_exact`` says;
    ``exact_counts`` spends a second scan on it.  With ``batch`` the rows go to a
    ``batch_id`` folder below each region, where ``ingest_new_files`` can add to them;
    what an earlier run wrote there under the same name goes first, so a job that is
    run again leaves its rows once.
    ``table`` registers the output, or refreshes it if it is registered.
    """
    if source_format not in ("csv", "json"):
        raise ValueError(f"source_format must be csv or json, not {source_format!r}")
    if glob is None and not is_file(spark, source_path):
        glob = FILES[source_format]
    if source_format == "json":
        raw = read_sales_json(spark, source_path, glob, recursive)
    elif drifted:
        raw = read_drifted(spark, source_path, glob=glob)
    else:
        raw = read_csv(spark, source_path, multiline=multiline, glob=glob, recursive=recursive)
    read, written = Observation(), Observation()
    source = counted(raw, read) if metrics else raw
    rows, by = clean_sales(source, drop_source_total), ["region"]
    if batch is not None:
        rows, by = rows.withColumn(BATCH, F.lit(batch)), ["region", BATCH]
        drop_batch(spark, output_path, by, batch)
    write_partitioned(
        rows,
        output_path,
        by=by,
        mode=mode,
        layout=layout,
        written=written if metrics else None,
    )
    if table:
        kept = [f for f in schemas.CLEAN_SALES if not (drop_source_total and f.name == "total_price")]
        levels = [T.StructField(BATCH, T.StringType())] if batch is not None else []
        register_table(spark, table, output_path, T.StructType(kept + levels), by)
    if not metrics:
        return {}
    rows_read = None if exact_counts else observed(read).get("rows")
    return {
        "rows_read": raw.count() if rows_read is None else rows_read,
        "rows_read_exact": rows_read is None,
        "rows_written": observed(written).get("rows", 0),
    }
