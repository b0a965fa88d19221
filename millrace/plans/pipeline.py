"""Raw -> clean -> enriched -> daily, one written table per stage."""

import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace import schemas
from millrace.operators.clean import clean_sales
from millrace.operators.marts import daily_region, duplicate_keys, enrich
from millrace.sinks.partitioned import clear_marker, is_committed, read_committed, write_partitioned
from millrace.sources.files import FILES, is_file, listing_digest, read_csv, read_sales_json, read_users

STAGES = ("raw", "clean", "enriched", "daily")


def run_pipeline(
    spark: SparkSession,
    sales_path: str,
    users_path: str,
    work_path: str,
    resume: bool = False,
    source_format: str = "csv",
    retries: int = 0,
) -> dict[str, str]:
    """Run the four stages; returns the path of each stage's table, and of ``rejected``.

    A stage reads only tables whose write finished, so a failed stage stops the
    run, after ``retries`` more tries.  Its error gets a note with the stage's name, and a file
    ``_failed`` in ``work_path`` tells both to others.  ``resume`` then goes on after the last finished stage
    instead of starting over.  A stage counts as finished if its table was made from the
    files that lie under the inputs now, with their sizes and times, which are noted beside it.
    A fresh run first takes the marks off all stages, so none of an older run can pass for
    one of its own.

    Sales are CSV, or JSON by ``source_format``.  Rows that the clean step leaves out go to
    ``rejected`` as they came, with a ``reject_reason``.
    """
    if source_format not in ("csv", "json"):
        raise ValueError(f"source_format must be csv or json, not {source_format!r}")
    paths = {stage: f"{work_path.rstrip('/')}/{stage}" for stage in (*STAGES, "rejected")}

    def read_sales() -> DataFrame:
        names = None if is_file(spark, sales_path) else FILES[source_format]
        return (read_csv if source_format == "csv" else read_sales_json)(spark, sales_path, glob=names)

    def clean() -> None:
        raw = read_committed(spark, paths["raw"], schemas.RAW_SALES)
        _replace(raw.filter("order_id is null").withColumn("reject_reason", F.lit("missing order_id")), paths["rejected"])
        write_partitioned(clean_sales(raw), paths["clean"], mode="replace", layout="local")

    write = {
        "raw": lambda: _replace(read_sales(), paths["raw"]),
        "clean": clean,
        "enriched": lambda: write_partitioned(
            enrich(
                read_committed(spark, paths["clean"], schemas.CLEAN_SALES),
                _unique_users(spark, users_path),
            ),
            paths["enriched"],
            mode="replace",
        ),
        "daily": lambda: _replace(
            daily_region(
                read_committed(spark, paths["enriched"], schemas.ENRICHED_SALES)
            ),
            paths["daily"],
        ),
    }
    sales = [sales_path, listing_digest(spark, sales_path)]
    users = [users_path, listing_digest(spark, users_path)]
    inputs = {stage: json.dumps(sales if stage in ("raw", "clean") else sales + users) for stage in STAGES}
    note = {stage: f"{work_path.rstrip('/')}/_{stage}_inputs" for stage in STAGES}
    if not resume:
        for stage in STAGES:
            clear_marker(spark, paths[stage])
    fresh = False
    for stage in STAGES:
        if not fresh and is_committed(spark, paths[stage]) and _read_text(spark, note[stage]) == inputs[stage]:
            continue
        if not fresh:
            for later in STAGES[STAGES.index(stage) :]:
                clear_marker(spark, paths[later])
        fresh = True
        _attempt(spark, stage, write[stage], retries, f"{work_path.rstrip('/')}/_failed")
        _write_text(spark, note[stage], inputs[stage])
    return paths


def _attempt(spark: SparkSession, stage: str, write, retries: int, note: str) -> None:
    """Run a stage, again if it fails; what stopped it is noted until a later run of it ends well."""
    for left in reversed(range(retries + 1)):
        try:
            write()
        except Exception as error:
            _write_text(spark, note, json.dumps({"stage": stage, "error": str(error)[:2000]}))
            if not left:
                error.add_note(f"in stage {stage}")
                raise
        else:
            files, place = _file(spark, note)
            files.delete(place, False)
            return


def _file(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    files, place = _file(spark, path)
    out = files.create(place, True)
    out.write(bytearray(text, "utf-8"))
    out.close()


def _read_text(spark: SparkSession, path: str) -> str | None:
    files, place = _file(spark, path)
    if not files.exists(place):
        return None
    stream = files.open(place)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _replace(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def _unique_users(spark: SparkSession, path: str) -> DataFrame:
    users = read_users(spark, path)
    copies = duplicate_keys(users, "user_id").limit(5).collect()
    if copies:
        raise ValueError(f"users repeat user_id: {[r['user_id'] for r in copies]}")
    return users
