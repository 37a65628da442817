"""History ingest run shape: landing folders -> history table.

``dates="all"`` rebuilds the table from every delivery folder (K2); a comma
list of ``yyyyMMdd`` dates replaces their look-back window (K1). One Spark
job writes the table (plus the schema-inference pass unless an envelope
schema is given); volume and rejects are observed on that same job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql.types import StructType

from quayside.errors import NoNewData, Outcome, RunResult
from quayside.functions.nested import is_nested, is_struct_like, nested_to_json
from quayside.operators.flatten import flatten_envelope
from quayside.operators.lineage import SOURCE_PATH, add_lineage
from quayside.operators.project import all_as_text
from quayside.operators.profile import distribution, metrics_of, observed
from quayside.session import PIPELINE_CONF, session_conf
from quayside.sinks.history import HistoryTable
from quayside.sinks.history_catalog import CatalogHistoryTable
from quayside.sources.json_feed import corrupt_count, corrupt_documents, infer_envelope_schema, read_envelopes, unsplit_files
from quayside.sources.landing import LandingFeed, window_dates_for


NESTED_RULES = {"all": is_nested, "struct_like": is_struct_like}


def history_frame(spark: SparkSession, paths: Sequence[str], envelope: str = "Data", *,
                  schema: StructType | None = None, recursive: bool = False,
                  as_text: bool = False, observation: Observation | None = None,
                  nested: str = "all", on_corrupt: str = "count") -> DataFrame:
    """Lazy history rows for the given folders: flatten, nested -> JSON text, lineage.

    ``nested="all"`` serialises every struct and array to JSON text;
    ``nested="struct_like"`` only structs and arrays of structs (arrays of
    scalars stay arrays). With ``observation`` the number of corrupt
    documents is observed on the same scan (reported once the rows are written).
    """
    if nested not in NESTED_RULES:
        raise ValueError(f"nested must be one of {sorted(NESTED_RULES)}")
    raw = read_envelopes(spark, paths, schema=schema, recursive=recursive, envelope=envelope, on_corrupt=on_corrupt)
    if observation is not None:
        raw = raw.observe(observation, corrupt_count(raw))
    rows = add_lineage(nested_to_json(flatten_envelope(raw, envelope, carry=[SOURCE_PATH]), NESTED_RULES[nested]))
    return all_as_text(rows) if as_text else rows


def ingest_history(spark: SparkSession, feed: LandingFeed, history: HistoryTable | CatalogHistoryTable, dates: str, *,
                   envelope: str = "Data", starting_from: str | None = None,
                   schema: StructType | None = None, as_text: bool = False,
                   max_records_per_file: int | None = None, single_file: bool = False,
                   nested: str = "all", rebalance: bool = False, on_corrupt: str = "count",
                   freshness_column: str | None = None, distribution_column: str | None = None) -> RunResult:
    """Run one ingest. NO_NEW_DATA when nothing can be read; errors propagate.

    Metrics: rows written and rejected, folders, corrupt documents, and the profile of the batch: ``volume``
    (all its rows, also rejected ones) and with ``freshness_column`` its greatest value, both observed on the
    write. ``distribution_column`` adds ``distribution``, a DataFrame of the written dates' rows per value.
    A column that the batch does not have is left out.

    ``rebalance=True`` writes through one AQE-sized shuffle by date, so files
    per date follow its volume (for feeds of many small documents).
    ``on_corrupt="fail"`` fails the run on a malformed document instead of
    counting it; the write job fails before it commits, so the table is unchanged.
    """
    with session_conf(spark, PIPELINE_CONF):
        return _ingest(spark, feed, history, dates, envelope, starting_from, schema, as_text, max_records_per_file,
                       single_file, nested, rebalance, on_corrupt, freshness_column, distribution_column)


def _ingest(spark: SparkSession, feed: LandingFeed, history: HistoryTable | CatalogHistoryTable, dates: str, envelope: str,
            starting_from: str | None, schema: StructType | None, as_text: bool, max_records_per_file: int | None,
            single_file: bool, nested: str, rebalance: bool, on_corrupt: str, freshness_column: str | None,
            distribution_column: str | None) -> RunResult:
    folders: list[str] = []
    try:
        folders = feed.date_folders(spark, dates, starting_from)
        if not folders:
            raise NoNewData(f"no delivery folder for {dates}")
        whole_files = unsplit_files(spark, folders)
        if schema is None:
            schema = infer_envelope_schema(spark, folders, settings=whole_files)
        scanned = Observation("landing_scan")
        rows = history_frame(spark, folders, envelope, schema=schema, as_text=as_text, observation=scanned,
                             nested=nested, on_corrupt=on_corrupt)
        rows, profile = observed(rows, "history_input", freshness_column if freshness_column in rows.columns else None)
        window = window_dates_for(dates, starting_from)
        layout = {"max_records_per_file": max_records_per_file, "single_file": single_file, "rebalance": rebalance}
        with session_conf(spark, whole_files):
            if window is None:
                metrics = history.replace_all(rows, **layout)
            else:
                metrics = history.replace_window(rows, window, **layout, refuse_empty=True)
    except NoNewData as exc:
        corrupt = corrupt_documents(spark, folders).count() if folders else 0
        return RunResult(Outcome.NO_NEW_DATA, str(exc), {"folders": len(folders), "corrupt_documents": corrupt})
    metrics["folders"] = len(folders)
    metrics.update(metrics_of(profile, volume=0))
    if distribution_column in rows.columns and metrics["dates_written"]:
        written = history.read(spark, [d.replace("-", "") for d in metrics["dates_written"]])
        metrics["distribution"] = distribution(written, distribution_column)
    metrics["corrupt_documents"] = metrics_of(scanned, corrupt_documents=0)["corrupt_documents"]
    return RunResult(Outcome.SUCCESS, "", metrics)
