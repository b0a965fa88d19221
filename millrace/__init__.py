"""millrace: Spark-native batch ETL for sales-style tables."""

from millrace.operators.asof import asof_join
from millrace.operators.cdc import (
    check_changes,
    current_state,
    rejected,
    scd2_history,
    scd2_incremental,
    usable,
)
from millrace.operators.clean import clean_sales, drop_null
from millrace.operators.intervals import interval_join, version_at
from millrace.operators.marts import daily_region, duplicate_keys, enrich
from millrace.operators.metrics import preview, row_metrics, schema_report
from millrace.operators.rollups import add_sales, merge_sketches, read_totals, sketch_days, sketch_estimates
from millrace.operators.sessions import rolling_sums, session_summary, with_sessions
from millrace.operators.snapshots import snapshot_changes
from millrace.plans.pipeline import run_pipeline
from millrace.plans.simple_etl import run_simple_etl
from millrace.sinks.catalog import query, register_table
from millrace.sinks.formats import write_drop
from millrace.sinks.partitioned import (
    is_committed,
    read_committed,
    write_partitioned,
)
from millrace.sources.files import (
    csv_headers,
    inline_table,
    read_changes,
    read_csv,
    read_drifted,
    read_transactions,
    read_users,
)
from millrace.sources.landing import list_landing, manifest
from millrace.streaming.changes import HistoryTables, apply_new_changes
from millrace.streaming.event_time import EventTables, event_totals, ingest_events
from millrace.streaming.incremental import ingest_new_files

__all__ = [
    "EventTables",
    "HistoryTables",
    "add_sales",
    "apply_new_changes",
    "asof_join",
    "check_changes",
    "clean_sales",
    "csv_headers",
    "current_state",
    "daily_region",
    "drop_null",
    "duplicate_keys",
    "enrich",
    "event_totals",
    "ingest_events",
    "ingest_new_files",
    "inline_table",
    "interval_join",
    "is_committed",
    "list_landing",
    "manifest",
    "merge_sketches",
    "preview",
    "query",
    "read_changes",
    "read_committed",
    "read_csv",
    "read_drifted",
    "read_totals",
    "read_transactions",
    "read_users",
    "register_table",
    "rejected",
    "rolling_sums",
    "row_metrics",
    "run_pipeline",
    "run_simple_etl",
    "scd2_history",
    "scd2_incremental",
    "schema_report",
    "session_summary",
    "sketch_days",
    "sketch_estimates",
    "snapshot_changes",
    "usable",
    "version_at",
    "with_sessions",
    "write_drop",
    "write_partitioned",
]
