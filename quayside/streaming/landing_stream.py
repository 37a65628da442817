"""Ingest delivery days as their files arrive (Structured Streaming).

A ``binaryFile`` stream over ``<root>/<dataset>/*/`` reports the paths of
newly arrived files (only ``path`` is selected, so file contents are not
read by the stream). Each micro-batch turns them into the set of delivery
days and runs the ordinary windowed history ingest (K1) for those days, so
the result is the same as a batch run with those dates. Progress is kept in
a checkpoint below the shared folder; a restarted or replayed micro-batch
re-ingests the same days, which yields the same table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quayside.errors import RunResult
from quayside.plans.history_ingest import ingest_history
from quayside.session import scratch_path
from quayside.sinks.history import HistoryTable
from quayside.sources.landing import LandingFeed

_DAY_FOLDER = r"/([0-9]{8})/[^/]+$"
_BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def arrived_days(batch: DataFrame) -> list[str]:
    """Distinct ``yyyyMMdd`` folder names of the files in a micro-batch (a few per day)."""
    days = (batch.select(F.regexp_extract("path", _DAY_FOLDER, 1).alias("day"))
            .where(F.col("day") != "").distinct().collect())
    return sorted(r.day for r in days)


def ingest_arrivals(spark: SparkSession, feed: LandingFeed, history: HistoryTable, *,
                    checkpoint: str | None = None, envelope: str = "Data",
                    on_result: Callable[[list[str], RunResult], None] | None = None,
                    available_now: bool = True, interval: str = "1 hour", folders: str = "*") -> StreamingQuery:
    """Start the stream; with ``available_now`` it processes what has arrived, then stops.

    ``folders`` is the glob of day folders the stream watches (``"2024*"`` for a year);
    the file source lists all of it on every trigger.
    """
    checkpoint = checkpoint or scratch_path(spark, "streams", feed.dataset)

    def run(batch: DataFrame, epoch_id: int) -> None:
        days = arrived_days(batch)
        if not days:
            return
        result = ingest_history(spark, feed, history, ",".join(days), envelope=envelope)
        if on_result is not None:
            on_result(days, result)

    files = (spark.readStream.format("binaryFile")
             .schema(_BINARY_FILE_SCHEMA)
             .load(f"{feed.path}/{folders}")
             .select("path"))
    writer = files.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()
