"""History table: parquet partitioned by ``ingestion_date``.

* Windowed replace (K1): rows of the look-back window replace exactly those
  dates. Dynamic partition overwrite swaps the dates the batch produced;
  window dates the batch did not produce are then dropped, so they end empty.
  Rows outside the window are rejected before the write.
* Full replace (K2): dynamic overwrite of every produced date, then the
  dates not produced are dropped; a failed rebuild leaves the old table.
* Schema evolution (K3): ``_SCHEMA`` at the root holds all columns the table
  has had, so a read opens no footer to find them and old rows read new
  columns as null. It is replaced before the rows are written; a change of a
  column's type is refused then, with the table as it was.
* Layout (K7): no ``coalesce(1)``. Each scan task writes its own files, one
  per date among the delivery files it read, with no shuffle. Spark packs
  files into tasks by size, so a task can hold several dates: the table has
  at most as many files per date as the landing. ``rebalance=True`` adds one
  AQE-sized shuffle by date for feeds of many small documents;
  ``max_records_per_file`` caps file size.
* No decision to delete hangs on a counter: dates written are those whose
  folders hold files they did not hold before the job.
* Changed dates: :meth:`HistoryTable.versions` tells from the files themselves
  which dates were written since, so a current-state run can read only those.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quayside.errors import NoNewData
from quayside.functions.dates import in_dates, to_date_values
from quayside.functions.names import col, resolve
from quayside.operators.lineage import INGESTION_DATE
from quayside.operators.profile import metrics_of
from quayside.operators.upsert import align, union_schema
from quayside.session import session_conf
from quayside.sources import fs


SCHEMA = "_SCHEMA"


@dataclass(frozen=True)
class HistoryTable:
    path: str
    partition_column: str = INGESTION_DATE

    def exists(self, spark: SparkSession) -> bool:
        return bool(self._partition_names(spark))

    def _partition_names(self, spark: SparkSession) -> set[str]:
        """Names of the partition folders (one listing of the table root)."""
        return {e.name for e in fs.list_dir(spark, self.path)
                if e.is_dir and e.name.startswith(f"{self.partition_column}=")}

    # -- S6 --------------------------------------------------------------------
    def read(self, spark: SparkSession, dates: Iterable[str] | None = None) -> DataFrame:
        """All history (default), or only ``dates`` (yyyyMMdd).

        With ``dates`` only those dates' partition folders are opened (with
        ``basePath``, so ``ingestion_date`` stays a typed partition column),
        and the date predicate is kept as a partition filter. Columns come
        from the stored schema; a table without one (written by other means)
        is read with ``mergeSchema``, which opens every footer.

        Raises :class:`NoNewData` when the table, or every requested date, has no partition.
        """
        names = self._partition_names(spark)  # also answers which requested dates exist
        if not names:
            raise NoNewData(f"history table {self.path} is empty")
        schema = self.schema(spark)
        reader = spark.read.option("mergeSchema", True) if schema is None else spark.read.schema(schema)
        if dates is None:
            return reader.parquet(self.path)
        dates = set(dates)
        present = [self.partition_dir(d) for d in to_date_values(dates)
                   if f"{self.partition_column}={d.isoformat()}" in names]
        if not present:
            raise NoNewData(f"history table {self.path} has no partition for {sorted(dates)}")
        return reader.option("basePath", self.path).parquet(*present).where(in_dates(self.partition_column, dates))

    def schema(self, spark: SparkSession) -> StructType | None:
        text = fs.read_text(spark, f"{self.path.rstrip('/')}/{SCHEMA}")
        return StructType.fromJson(json.loads(text)) if text else None

    def _evolve(self, df: DataFrame, replace: bool) -> tuple[DataFrame, StructType]:
        """``df`` with the table's column names and types where it has them, and the table's schema
        from now on. Raises :class:`ContractError` for a column whose type changed."""
        spark = df.sparkSession
        old = None if replace else self.schema(spark)
        if old is None:
            old = spark.read.option("mergeSchema", True).parquet(self.path).schema \
                if not replace and self._partition_names(spark) else StructType()
        sensitive = str(spark.conf.get("spark.sql.caseSensitive", "false")).lower() == "true"
        whole = union_schema(old, df.schema, sensitive)
        mine = StructType([f for f in whole.fields if resolve(f.name, df.columns, sensitive) is not None])
        part = [f for f in whole.fields if f.name == self.partition_column]
        return align(df, mine), StructType([f for f in whole.fields if f.name != self.partition_column] + part)

    def _store_schema(self, spark: SparkSession, schema: StructType) -> None:
        if schema != self.schema(spark):
            fs.write_text(spark, f"{self.path.rstrip('/')}/{SCHEMA}", schema.json())

    def _files(self, spark: SparkSession, names: Iterable[str] | None) -> dict[str, set[str]]:
        """Files of the partition folders ``names``, by one listing each; of all of them, by one listing in all."""
        if names is not None:
            return {n: {e.name for e in fs.list_dir(spark, f"{self.path.rstrip('/')}/{n}")} for n in names}
        found: dict[str, set[str]] = {}
        for e in fs.list_files_recursive(spark, self.path):
            folder, name = e.path.rsplit("/", 2)[-2:]
            if folder.startswith(f"{self.partition_column}="):
                found.setdefault(folder, set()).add(name)
        return found

    def _swap(self, batch: DataFrame, names: Iterable[str] | None, schema: StructType, writer_options: tuple) -> set[str]:
        """Write the batch by dynamic overwrite; the partition folders that got new files. ``names``:
        the folders that may, all by default."""
        spark = batch.sparkSession
        before = self._files(spark, names)
        (self._writer(batch, *writer_options).mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").parquet(self.path))
        after = self._files(spark, names)
        written = {n for n, files in after.items() if files - before.get(n, set())}
        if written:
            self._store_schema(spark, schema)
        return written

    def partition_dir(self, day: dt.date) -> str:
        return f"{self.path.rstrip('/')}/{self.partition_column}={day.isoformat()}"

    def _writer(self, df: DataFrame, max_records_per_file: int | None, single_file: bool,
                rebalance: bool = False):
        if single_file:  # the one-task layout, kept only for comparison runs
            df = df.coalesce(1)
        elif rebalance:
            # One shuffle by date, sized by AQE: small partitions are coalesced and a hot
            # date's partition is split (advisoryPartitionSizeInBytes), so files per date
            # follow the date's volume instead of how delivery files were packed into tasks.
            df = df.hint("rebalance", self.partition_column)
        w = df.write.partitionBy(self.partition_column)
        if max_records_per_file:
            w = w.option("maxRecordsPerFile", max_records_per_file)
        return w

    # -- K1 --------------------------------------------------------------------
    def replace_window(self, df: DataFrame, window: Iterable[str], *, max_records_per_file: int | None = None,
                       single_file: bool = False, rebalance: bool = False, refuse_empty: bool = False) -> dict:
        """Make the window dates hold exactly ``df``'s rows for those dates.

        ``refuse_empty``: raise :class:`NoNewData`, with the table as it was,
        if ``df`` has no rows at all.

        Returns metrics: rows written, rows rejected (outside the window or
        with no date), dates written and dates emptied. Safe to replay: the
        same input gives the same table. Not atomic for concurrent readers.
        """
        window = set(window)
        days = to_date_values(window)
        df, schema = self._evolve(df, replace=False)
        spark, part, prefix = df.sparkSession, col(self.partition_column), f"{self.partition_column}="
        inside = in_dates(self.partition_column, window)
        seen, kept = Observation("history_batch"), Observation("history_window")
        batch = df.observe(seen, F.count(F.lit(1)).alias("rows_in"),
                           F.count_if(part.isNull() | ~inside).alias("rows_rejected"))
        batch = batch.where(inside).observe(kept, F.count(F.lit(1)).alias("rows"))
        names = [f"{prefix}{d.isoformat()}" for d in days]
        written = sorted(n[len(prefix):] for n in self._swap(
            batch, names, schema, (max_records_per_file, single_file, rebalance)))
        rows_in = metrics_of(seen, rows_in=0, rows_rejected=0)
        if refuse_empty and not written and not rows_in["rows_in"]:
            raise NoNewData("no row for the window")
        emptied = [d.isoformat() for d in days if d.isoformat() not in written]
        for d in emptied:
            fs.delete(spark, f"{self.path.rstrip('/')}/{prefix}{d}")
        return {**metrics_of(kept, rows=0), **rows_in,
                "dates_written": written, "dates_emptied": emptied}

    # -- K2 --------------------------------------------------------------------
    def replace_all(self, df: DataFrame, *, max_records_per_file: int | None = None,
                    single_file: bool = False, rebalance: bool = False) -> dict:
        """Replace the whole table with ``df`` (rows without a date are rejected).

        Written as a dynamic partition overwrite, which changes nothing until
        the job commits, so a rebuild that fails half-way leaves the old
        table intact (a static overwrite deletes it first). Partitions the
        rebuild did not produce are dropped afterwards:
        those whose folders got no new file. Raises :class:`NoNewData`, with
        the table as it was, when no row has a date.
        """
        df, schema = self._evolve(df, replace=True)
        spark, part, prefix = df.sparkSession, col(self.partition_column), f"{self.partition_column}="
        seen = Observation("history_full")
        batch = df.observe(seen, F.count(F.lit(1)).alias("rows_in"), F.count_if(part.isNull()).alias("rows_rejected"))
        folders = self._swap(batch.where(part.isNotNull()), None, schema, (max_records_per_file, single_file, rebalance))
        if not folders:  # nothing was deleted yet
            raise NoNewData(f"no row with a date to replace {self.path} with")
        dropped = sorted(self._partition_names(spark) - folders)
        for n in dropped:
            fs.delete(spark, f"{self.path.rstrip('/')}/{n}")
        written = sorted(n[len(prefix):] for n in folders)
        m = metrics_of(seen, rows_in=0, rows_rejected=0)
        return {"rows": m["rows_in"] - m["rows_rejected"], **m, "dates_written": written,
                "dates_dropped": [n[len(prefix):] for n in dropped]}

    # -- versions of dates (for incremental current-state runs) -------------------
    def versions(self, spark: SparkSession) -> dict[str, str]:
        """What tells whether a date (``yyyyMMdd``) was written again: a digest of the names, lengths and
        times of its files. One row for each date comes to the driver.

        Spark's listing gives the files, and no file is opened: only metadata columns are asked for."""
        if not self._partition_names(spark):
            return {}
        files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(self.path)
                 .select(col(self.partition_column).cast("date").alias("d"), F.xxhash64("path", "length", "modificationTime").alias("h")))
        digests = files.where("d is not null").groupBy("d").agg(F.count("*").alias("n"), F.bit_xor("h").alias("h"))
        with session_conf(spark, {"spark.sql.files.maxPartitionBytes": str(1 << 50)}):  # tasks by cores, not by bytes
            rows = digests.collect()
        return {f"{r['d']:%Y%m%d}": f"{r['n']}:{r['h']}" for r in rows}


def replace_window_frame(history: DataFrame, batch: DataFrame, window: Iterable[str],
                         partition_column: str = INGESTION_DATE) -> DataFrame:
    """DataFrame form of K1: history outside the window, plus batch rows inside it.

    Columns are unioned by name (missing ones null), matching the table's
    schema evolution.
    """
    inside_h = in_dates(partition_column, window)
    inside_b = in_dates(partition_column, window)
    kept = history.where(~inside_h | col(partition_column).isNull())
    return kept.unionByName(batch.where(inside_b), allowMissingColumns=True)
