"""The jobs from the command line.

    spark-submit --py-files millrace.zip run.py simple-etl \\
        --source-path IN --output-path OUT

or ``python -m millrace <job> ...`` where PySpark is installed.  Each job prints
one JSON line when it is done, and fails with a traceback before that.
"""

import argparse
import json
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import SparkSession, types as T

from millrace import schemas
from millrace.operators import generate
from millrace.operators.metrics import preview
from millrace.plans.pipeline import run_pipeline
from millrace.plans.simple_etl import run_simple_etl
from millrace.session import build_session
from millrace.sinks.formats import write_drop
from millrace.sinks.partitioned import read_committed
from millrace.sources.landing import list_landing, manifest
from millrace.streaming.changes import HistoryTables, apply_new_changes
from millrace.streaming.incremental import ingest_new_files


def _simple_etl(spark: SparkSession, args) -> dict:
    result = run_simple_etl(
        spark,
        args.source_path,
        args.output_path,
        mode=args.mode,
        layout=args.layout,
        drifted=args.drifted,
        multiline=args.multiline,
        drop_source_total=args.drop_source_total,
        exact_counts=args.exact_counts,
        source_format=args.format,
        glob=args.glob,
        recursive=not args.flat,
        batch=args.batch,
        table=args.table,
    )
    if args.preview:
        schema = schemas.CLEAN_SALES
        if args.drop_source_total:
            schema = T.StructType([f for f in schema if f.name != "total_price"])
        written = read_committed(spark, args.output_path, schema)
        written.printSchema()
        preview(written).show(truncate=False)
    return result


def _pipeline(spark: SparkSession, args) -> dict:
    return run_pipeline(
        spark, args.sales_path, args.users_path, args.work_path, args.resume, args.format, args.retries
    )


def _ingest(spark: SparkSession, args) -> dict:
    ingest_new_files(
        spark,
        args.source_path,
        args.output_path,
        args.checkpoint_path,
        max_files=args.max_files,
        source_format=args.format,
        archive_path=args.archive_path,
    )
    return {"output_path": args.output_path}


def _changes(spark: SparkSession, args) -> dict:
    base = args.table_path.rstrip("/")
    tables = HistoryTables(
        log=f"{base}/log",
        history=f"{base}/history",
        rejects=f"{base}/rejects",
        checkpoint=f"{base}/checkpoint",
        buckets=args.buckets,
    )
    apply_new_changes(spark, args.source_path, tables, args.max_files)
    return {"history": tables.history}


def _generate(spark: SparkSession, args) -> dict:
    ids = spark.range(args.rows)
    name = args.dataset
    if name == "sales":
        df = generate.sales(ids, args.seed, args.users, args.null_rate)
    elif name == "users":
        df = generate.users(ids, args.seed)
    elif name == "transactions":
        df = generate.transactions(ids, args.seed, args.users)
    else:
        df = generate.changes(ids, args.mode, args.seed, args.users, args.base_rows)
        name = f"cdc_{args.mode}"
    return {"path": write_drop(df, name, args.output_dir, datetime.now())}


def _manifest(spark: SparkSession, args) -> dict:
    table = manifest(list_landing(spark, args.folder), args.target)
    table.write.mode("overwrite").json(args.output_path)
    return {"output_path": args.output_path}


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="millrace", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name, run, *required):
        sub = jobs.add_parser(name)
        sub.set_defaults(run=run)
        for option in required:
            sub.add_argument(option, required=True)
        return sub

    etl = job("simple-etl", _simple_etl, "--source-path", "--output-path")
    etl.add_argument(
        "--mode", default="append", choices=("append", "overwrite", "replace")
    )
    etl.add_argument("--layout", default="local", choices=("rebalance", "local"))
    etl.add_argument("--drifted", action="store_true")
    etl.add_argument("--multiline", action="store_true")
    etl.add_argument("--drop-source-total", action="store_true")
    etl.add_argument("--exact-counts", action="store_true")
    etl.add_argument("--preview", action="store_true")
    etl.add_argument("--format", default="csv", choices=("csv", "json"))
    etl.add_argument("--glob")
    etl.add_argument("--flat", action="store_true", help="leave folders below out")
    etl.add_argument("--batch", help="name of a batch_id folder, to ingest more later")
    etl.add_argument("--table", help="register the output, or refresh it")

    steps = job("pipeline", _pipeline, "--sales-path", "--users-path", "--work-path")
    steps.add_argument("--resume", action="store_true")
    steps.add_argument("--format", choices=["csv", "json"], default="csv")
    steps.add_argument("--retries", type=int, default=0)

    new = job("ingest", _ingest, "--source-path", "--output-path", "--checkpoint-path")
    new.add_argument("--max-files", type=int)
    new.add_argument("--format", default="csv", choices=("csv", "json"))
    new.add_argument("--archive-path")

    log = job("apply-changes", _changes, "--source-path", "--table-path")
    log.add_argument("--buckets", type=int, default=256)
    log.add_argument("--max-files", type=int)

    data = job("generate", _generate, "--output-dir")
    data.add_argument(
        "dataset", choices=("sales", "users", "transactions", "changes")
    )
    data.add_argument("--rows", type=int, default=1000)
    data.add_argument("--seed", type=int, default=1)
    data.add_argument("--users", type=int, default=1000)
    data.add_argument("--null-rate", type=float, default=0.0)
    data.add_argument("--mode", default="full", choices=("full", "incremental"))
    data.add_argument("--base-rows", type=int)

    job("manifest", _manifest, "--folder", "--target", "--output-path")
    return parser


def main(argv: Sequence[str] | None = None) -> dict:
    args = _parser().parse_args(argv)
    result = args.run(build_session(f"millrace-{args.job}"), args)
    print(json.dumps({"job": args.job, **result}))
    return result


if __name__ == "__main__":
    main()
