"""Current-state build run shape: history table -> conformed, typed, upserted table.

Steps: scan history (all of it by default, or only given dates with
partition pruning) -> conform to the contract's source schema -> contract
projection -> run stamp -> upsert (or reload for ``all``) into the bucketed
current-state table -> refresh the view.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.errors import NoNewData, Outcome, RunResult
from quayside.operators.lineage import stamp_run
from quayside.operators.profile import distribution, metrics_of, observed
from quayside.operators.project import LOST_PREFIX, apply_contract, conform_to_schema
from quayside.plans.contract import Contract
from quayside.session import PIPELINE_CONF, session_conf
from quayside.sinks.current import CurrentStateTable
from quayside.sinks.history import HistoryTable
from quayside.sinks.views import publish_current


def current_frame(history_rows: DataFrame, contract: Contract, strict: bool = False,
                  loss_flags: bool = False) -> DataFrame:
    """Typed rows of the contract (all versions, before the latest-per-key step).

    ``loss_flags`` adds the ``__lost_<field>`` columns of :func:`apply_contract`.
    """
    conformed = conform_to_schema(history_rows, contract.origin_schema, strict=strict, loss_flags=loss_flags)
    return stamp_run(apply_contract(conformed, contract.fields, strict=strict, loss_flags=loss_flags))


def build_current_state(spark: SparkSession, history: HistoryTable, contract: Contract,
                        target: CurrentStateTable, *, reload: bool = False,
                        dates: Iterable[str] | None = None, view: str | None = None,
                        persistent_view: bool = False, changed_only: bool = False,
                        strict: bool = False, freshness_column: str | None = None,
                        distribution_column: str | None = None) -> RunResult:
    """One current-state run. Metrics: rows written, and the
    profile of the incoming rows (``volume`` counts every version, before the
    latest-per-key step; ``freshness`` is the max of ``freshness_column``;
    ``cast_nulls_<field>`` counts values a lenient cast or pattern turned into
    null; ``distribution_column`` adds ``distribution``, a DataFrame of the state's rows per value of it), observed on the run's own jobs rather than by another scan.

    History read: all of it by default (the source semantics); ``dates`` reads
    only those dates; ``changed_only`` reads only the dates whose files differ
    from those that the target's live build has absorbed. For the upsert
    that gives the state a full read gives (a key's newest row can only change
    where its dates changed; upserts never delete), except that untouched rows
    keep their ``processing_time``. (Exact for the default order column, the
    history date; with another order column, a target row removed from
    history can lose a tie to an unchanged row only in a full read.) It falls
    back to a full read when it is not known what the target has absorbed. Full
    and change-driven runs note the dates' versions as they were before the
    read; a run over explicit dates leaves them as they are.
    """
    with session_conf(spark, PIPELINE_CONF):
        return _build(spark, history, contract, target, reload, dates, view, persistent_view, changed_only, strict,
                      freshness_column, distribution_column)


def _build(spark: SparkSession, history: HistoryTable, contract: Contract, target: CurrentStateTable, reload: bool,
           dates: Iterable[str] | None, view: str | None, persistent_view: bool, changed_only: bool, strict: bool,
           freshness_column: str | None, distribution_column: str | None) -> RunResult:
    dates = None if dates is None else sorted(dates)
    if changed_only and dates is not None:
        raise ValueError("changed_only and dates are exclusive")
    if freshness_column is not None and freshness_column not in contract.target_schema().fieldNames() \
            and freshness_column != "ingestion_date":
        freshness_column = None  # the contract has no such column: report volume only
    incremental = changed_only and not reload and target.exists(spark)
    known = target.absorbed(spark) if incremental or dates is not None and not reload else None
    versions = history.versions(spark) if dates is None else known  # before the read; explicit dates advance nothing
    if incremental and known is not None:
        dates = sorted(d for d, v in versions.items() if known.get(d) != v)
        if not dates:
            return RunResult(Outcome.NO_NEW_DATA, "no history change since the last run", {"history_dates": []})
    try:
        found = history.read(spark, dates)
        if found.isEmpty():
            raise NoNewData("no history rows")
        typed = current_frame(found, contract, strict, loss_flags=True)
        lost = [c for c in typed.columns if c.startswith(LOST_PREFIX)]
        rows, profile = observed(typed, "current_state_input", freshness_column,
                                 extra=[F.count_if(F.col(c)).alias("cast_nulls_" + c[len(LOST_PREFIX):])
                                        for c in lost])
        rows = rows.drop(*lost)
        metrics = (target.reload if reload else target.upsert)(spark, rows, versions)
    except NoNewData as exc:
        return RunResult(Outcome.NO_NEW_DATA, str(exc))
    metrics.update(metrics_of(profile, volume=0))
    metrics["history_dates"] = "all" if dates is None else sorted(dates)
    if view:
        publish_current(spark, view, target, persistent=persistent_view)
    if distribution_column:
        metrics["distribution"] = distribution(target.read(spark), distribution_column)
    return RunResult(Outcome.SUCCESS, "", metrics)
