"""Command-line entry points for the two run shapes (``python -m quayside ...``).

    python -m quayside history --landing-root R --dataset D --dates 20240110,20240115 --history H
    python -m quayside current --history H --contract C.json --target T --key id --dates all
    python -m quayside current ... --dates 20240115 --window-only   # read only 14-15 Jan of the history

``--dates all`` rebuilds (history: full replace; current state: reload).
Prints the run result as one JSON line. Exit code 0 for SUCCESS and
NO_NEW_DATA, 1 for an error (the exception is re-raised after reporting).
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quayside.functions.names import quote
from quayside.errors import Outcome, RunResult
from quayside.functions.dates import lookback_window
from quayside.operators.latest import ROW_HASH
from quayside.operators.upsert import NULL_KEY_POLICIES
from quayside.plans.contract import Contract
from quayside.plans.current_state import build_current_state
from quayside.plans.history_ingest import ingest_history
from quayside.session import new_scratch_path
from quayside.sinks.current import CurrentStateTable
from quayside.sinks.history import HistoryTable
from quayside.sinks.history_catalog import CatalogHistoryTable
from quayside.sinks.views import publish_over, publish_view
from quayside.sources import fs
from quayside.sources.landing import LandingFeed


def _view_kind(p: argparse.ArgumentParser) -> None:
    p.add_argument("--persistent-view", action="store_true",
                   help="publish --view in the session catalog, so that it outlives the run (the default)")
    p.add_argument("--temporary-view", action="store_true", help="publish --view for this session only")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="quayside")
    sub = p.add_subparsers(dest="command", required=True)
    h = sub.add_parser("history", help="landing folders -> history table")
    h.add_argument("--landing-root", required=True)
    h.add_argument("--dataset", required=True)
    h.add_argument("--dates", required=True, help="'all' or comma list of yyyyMMdd")
    h.add_argument("--history", required=True, help="history table path")
    h.add_argument("--history-table", default=None,
                   help="catalog name of the history: dates are then switched in the catalog, files lie in --history")
    h.add_argument("--envelope", default="Data")
    h.add_argument("--freshness-column", default=None)
    h.add_argument("--distribution-column", default=None, help="report the written dates' rows per value of this column")
    h.add_argument("--distribution-output", default=None, help="folder for the whole distribution")
    h.add_argument("--starting-from", default=None)
    h.add_argument("--as-text", action="store_true", help="cast every data column to string")
    h.add_argument("--nested", choices=["all", "struct_like"], default="all",
                   help="serialise every struct and array to JSON text, or only structs and arrays of structs")
    h.add_argument("--max-records-per-file", type=int, default=None)
    h.add_argument("--fail-on-corrupt", action="store_true",
                   help="fail the run on a malformed delivery document instead of counting it")
    h.add_argument("--rebalance", action="store_true",
                   help="one AQE-sized shuffle by date before writing (feeds of many small documents)")
    h.add_argument("--view", default=None, help="view to (re)publish over the history")
    _view_kind(h)
    h.add_argument("--envelope-schema", default=None,
                   help="file with the Spark schema JSON of a delivery document; skips the inference pass")
    c = sub.add_parser("current", help="history table -> current-state table")
    c.add_argument("--history", required=True)
    c.add_argument("--history-table", default=None, help="catalog name of the history")
    c.add_argument("--distribution-output", default=None, help="folder for the whole distribution")
    c.add_argument("--contract", required=True, help="contract JSON file")
    c.add_argument("--target", required=True, help="catalog name of the current state (a view over its live build)")
    c.add_argument("--target-location", default=None, help="folder for its files (default: the catalog's warehouse)")
    c.add_argument("--key", default="id")
    c.add_argument("--order", default="ingestion_date")
    c.add_argument("--tiebreak", default=None,
                   help="comma list of columns ordering rows of one key and one date, greatest first "
                        "(default: a hash of the row, so reruns pick the same row)")
    c.add_argument("--buckets", type=int, default=64)
    c.add_argument("--on-null-key", choices=NULL_KEY_POLICIES, default="keep", help="rows without a key")
    c.add_argument("--distribution-column", default=None, help="report the state's rows per value of this column")
    c.add_argument("--dates", default="all",
                   help="'all' = reload from all history; else upsert (from all history by default)")
    c.add_argument("--window-only", action="store_true",
                   help="upsert from the dates' look-back window of the history only (partition-pruned read)")
    c.add_argument("--full-scan", action="store_true", help="upsert from all history (the default; kept for scripts)")
    c.add_argument("--changed-only", action="store_true",
                   help="upsert from the history dates whose files changed since the last run; "
                        "same state as a full read, falls back to one at first")
    c.add_argument("--strict", action="store_true", help="plain casts: bad values fail the run")
    c.add_argument("--keep-generations", type=int, default=None,
                   help="builds that stay after a successful run, the live one among them (default 2)")
    c.add_argument("--freshness-column", default=None)
    c.add_argument("--view", default=None, help="further view over the current state")
    _view_kind(c)
    return p


#: Values that the printed result lists; all of them are in the distribution's folder.
LISTED = 100


def _history(args: argparse.Namespace) -> HistoryTable | CatalogHistoryTable:
    return CatalogHistoryTable(args.history_table, args.history) if args.history_table else HistoryTable(args.history)


def _report(spark: SparkSession, args: argparse.Namespace, result: RunResult) -> RunResult:
    """The distribution as the most frequent values; all values go to a folder."""
    found = result.metrics.get("distribution")
    if found is not None:
        where = args.distribution_output or new_scratch_path(spark, "distribution")
        found.write.mode("overwrite").parquet(where)
        written = spark.read.schema(found.schema).parquet(where)
        value = found.columns[0]
        result.metrics["distribution"] = [r.asDict() for r in written.orderBy(F.desc("count"), F.asc(quote(value))).limit(LISTED).collect()]
        result.metrics["distribution_values"] = written.count()
        result.metrics["distribution_output"] = where
    return result


def run(argv: list[str], spark: SparkSession | None = None) -> RunResult:
    args = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"quayside-{args.command}").getOrCreate()
    if args.command == "history":
        dates = args.dates.strip().lower()
        history = _history(args)
        schema = None
        if args.envelope_schema:
            text = fs.read_text(spark, args.envelope_schema)
            if text is None:
                raise FileNotFoundError(args.envelope_schema)
            schema = StructType.fromJson(json.loads(text))
        result = ingest_history(spark, LandingFeed(args.landing_root, args.dataset), history, dates,
                                envelope=args.envelope, starting_from=args.starting_from, as_text=args.as_text,
                                max_records_per_file=args.max_records_per_file, schema=schema,
                                rebalance=args.rebalance, nested=args.nested,
                                on_corrupt="fail" if args.fail_on_corrupt else "count",
                                freshness_column=args.freshness_column, distribution_column=args.distribution_column)
        if result.ok and args.view and args.history_table:
            publish_over(spark, args.view, args.history_table, persistent=not args.temporary_view)
        elif result.ok and args.view:
            publish_view(spark, args.view, history.path, persistent=not args.temporary_view,
                         schema=history.schema(spark), partitions=[history.partition_column])
        return _report(spark, args, result)
    dates = args.dates.strip().lower()
    reload = dates == "all"
    window = sorted(lookback_window(dates)) if args.window_only and not reload and not args.full_scan else None
    tiebreak = [c.strip() for c in args.tiebreak.split(",") if c.strip()] if args.tiebreak else ROW_HASH
    target = CurrentStateTable(args.target, key=args.key, order=args.order, num_buckets=args.buckets, tiebreak=tiebreak,
                               on_null_key=args.on_null_key, location=args.target_location,
                               keep=1 if args.keep_generations is None else max(0, args.keep_generations - 1))
    result = build_current_state(spark, _history(args), Contract.load(args.contract, spark), target,
                               reload=reload, dates=window, view=args.view, persistent_view=not args.temporary_view,
                               changed_only=args.changed_only and window is None,
                               strict=args.strict,
                               freshness_column=args.freshness_column,
                               distribution_column=args.distribution_column)
    return _report(spark, args, result)


def main(argv: list[str] | None = None) -> int:
    try:
        result = run(sys.argv[1:] if argv is None else argv)
    except Exception as exc:
        print(json.dumps({"outcome": Outcome.ERROR.value, "message": str(exc)}))
        raise
    print(json.dumps({"outcome": result.outcome.value, "message": result.message, "metrics": result.metrics},
                     default=str))
    return 0
