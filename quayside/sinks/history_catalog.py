"""History table kept in the catalog: each date is a partition with a location of its own.

A run writes its rows to a fresh folder, ``<location>/run-<time>-<id>/<date>``. Then the catalog is told, date by
date: a date with new rows gets the new folder as its location, a window date without any is dropped.
Files are never changed or overwritten, so:

* a run that fails before its rows are written leaves the table as it was, and its folder is removed;
* each date changes in one step, and readers that planned their scan before finish on the files they
  planned: replaced folders are removed by the next run but one;
* views over the table (K8) need no refresh: they follow the catalog, which only hears of changed dates.

Columns are the catalog's (K3): new ones are added before the dates change, a changed type is refused.
Runs on one table must not overlap.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from quayside.errors import NoNewData
from quayside.functions.dates import in_dates, to_date_values
from quayside.functions.names import col, quote, resolve
from quayside.operators.lineage import INGESTION_DATE
from quayside.operators.profile import metrics_of
from quayside.operators.upsert import align, union_schema
from quayside.sinks.views import split_quoted
from quayside.sources import fs

#: Table properties: folders that the last run replaced, and the last run that replaced all dates.
_RETIRED, _SINCE = "quayside.retired", "quayside.since"
_AT_ONCE = 200  # partitions in one statement


@dataclass(frozen=True)
class CatalogHistoryTable:
    """``name``: the catalog table, with or without its database. ``location``: folder of the runs."""

    name: str
    location: str
    partition_column: str = INGESTION_DATE

    @property
    def path(self) -> str:
        return self.location

    def _table(self, spark: SparkSession) -> str:
        return ".".join(split_quoted(spark, self.name))

    def _dates(self, spark: SparkSession) -> set[str]:
        """The dates that the catalog has, as ISO text."""
        if not spark.catalog.tableExists(self._table(spark)):
            return set()
        prefix = f"{self.partition_column}="
        return {r[0][len(prefix):] for r in spark.sql(f"SHOW PARTITIONS {self._table(spark)}").collect()}

    def exists(self, spark: SparkSession) -> bool:
        return bool(self._dates(spark))

    # -- S6 -----------------------------------------------------------------------
    def read(self, spark: SparkSession, dates: Iterable[str] | None = None) -> DataFrame:
        """All history, or only ``dates`` (yyyyMMdd), which the catalog prunes to their folders. Raises
        :class:`NoNewData` when the table, or every requested date, is missing."""
        there = self._dates(spark)
        if not there:
            raise NoNewData(f"history table {self.name} is empty")
        rows = spark.table(self._table(spark))
        if dates is None:
            return rows
        dates = set(dates)
        if not there & {d.isoformat() for d in to_date_values(dates)}:
            raise NoNewData(f"history table {self.name} has no partition for {sorted(dates)}")
        return rows.where(in_dates(self.partition_column, dates))

    def schema(self, spark: SparkSession) -> StructType | None:
        table = self._table(spark)
        return spark.table(table).schema if spark.catalog.tableExists(table) else None

    def versions(self, spark: SparkSession) -> dict[str, str]:
        """What tells whether a date (``yyyyMMdd``) was written again: a digest of its files' names. One row
        for each date comes to the driver; of the files only metadata is read."""
        if not self.exists(spark):
            return {}
        files = spark.table(self._table(spark)).select(
            col(self.partition_column).alias("d"), F.xxhash64("_metadata.file_path").alias("h")).distinct()
        rows = files.groupBy("d").agg(F.count("*").alias("n"), F.bit_xor("h").alias("h")).collect()
        return {f"{r['d']:%Y%m%d}": f"{r['n']}:{r['h']}" for r in rows}

    # -- K1 -----------------------------------------------------------------------
    def replace_window(self, df: DataFrame, window: Iterable[str], *, max_records_per_file: int | None = None,
                       single_file: bool = False, rebalance: bool = False, refuse_empty: bool = False) -> dict:
        """Make the window dates hold exactly ``df``'s rows for those dates. Safe to replay. Rows outside
        the window or without a date are counted and not written. ``refuse_empty``: raise
        :class:`NoNewData` if ``df`` has no rows at all."""
        window = set(window)
        days = [d.isoformat() for d in to_date_values(window)]
        seen = Observation("history_batch")
        part, inside = col(self.partition_column), in_dates(self.partition_column, window)
        batch = df.observe(seen, F.count(F.lit(1)).alias("rows_in"), F.count_if(part.isNull() | ~inside).alias("rows_rejected"))
        run, written, metrics = self._write(batch.where(inside), df, seen, (max_records_per_file, single_file, rebalance))
        if refuse_empty and not written and not metrics["rows_in"]:
            fs.delete(df.sparkSession, run)
            raise NoNewData("no row for the window")
        emptied = sorted(set(days) - set(written))
        self._switch(df.sparkSession, run, written, emptied)
        return {**metrics, "dates_written": sorted(written), "dates_emptied": emptied}

    # -- K2 -----------------------------------------------------------------------
    def replace_all(self, df: DataFrame, *, max_records_per_file: int | None = None,
                    single_file: bool = False, rebalance: bool = False) -> dict:
        """Replace every date. Columns that only earlier rows had stay, as nulls. Raises
        :class:`NoNewData`, with the table as it was, when no row has a date."""
        spark, part = df.sparkSession, col(self.partition_column)
        seen = Observation("history_full")
        batch = df.observe(seen, F.count(F.lit(1)).alias("rows_in"), F.count_if(part.isNull()).alias("rows_rejected"))
        run, written, metrics = self._write(batch.where(part.isNotNull()), df, seen, (max_records_per_file, single_file, rebalance))
        if not written:
            fs.delete(spark, run)
            raise NoNewData(f"no row with a date to replace {self.name} with")
        dropped = sorted(self._dates(spark) - set(written))
        self._switch(spark, run, written, dropped, everything=True)
        return {**metrics, "dates_written": sorted(written), "dates_dropped": dropped}

    # -- steps of a run --------------------------------------------------------------
    def _write(self, batch: DataFrame, df: DataFrame, seen: Observation, layout: tuple) -> tuple[str, list[str], dict]:
        """Rows to a folder of their own, with the table's names and types; the dates that have any."""
        spark = df.sparkSession
        most, single_file, rebalance = layout
        self._evolve(spark, df.schema)
        table = spark.table(self._table(spark)).schema
        sensitive = str(spark.conf.get("spark.sql.caseSensitive", "false")).lower() == "true"
        mine = StructType([f for f in table.fields if resolve(f.name, df.columns, sensitive) is not None])
        rows = align(batch, mine)
        rows = rows.coalesce(1) if single_file else rows.hint("rebalance", self.partition_column) if rebalance else rows
        w = rows.write.partitionBy(self.partition_column)
        if most:
            w = w.option("maxRecordsPerFile", most)
        run = f"{self.location.rstrip('/')}/run-{int(time.time() * 1000):013d}-{uuid.uuid4().hex[:8]}"
        try:
            w.parquet(run)
        except BaseException:
            fs.delete(spark, run)  # no date points at it
            raise
        prefix = f"{self.partition_column}="
        written = [e.name[len(prefix):] for e in fs.list_dir(spark, run) if e.is_dir and e.name.startswith(prefix)]
        m = metrics_of(seen, rows_in=0, rows_rejected=0)
        return run, written, {"rows": m["rows_in"] - m["rows_rejected"], **m}

    def _evolve(self, spark: SparkSession, schema: StructType) -> None:
        """Create the table, or add the columns that it does not have. Types are checked before."""
        table, sensitive = self._table(spark), str(spark.conf.get("spark.sql.caseSensitive", "false")).lower() == "true"
        ddl = lambda f: f"{quote(f.name)} {f.dataType.simpleString()}"
        plain = [f for f in schema.fields if f.name != self.partition_column]
        if not spark.catalog.tableExists(table):
            fields = ", ".join(map(ddl, [*plain, StructField(self.partition_column, schema[self.partition_column].dataType)]))
            spark.sql(f"CREATE TABLE {table} ({fields}) USING parquet PARTITIONED BY ({quote(self.partition_column)}) "
                      f"LOCATION '{self.location.rstrip('/')}/_table'")
            return
        old = spark.table(table).schema
        mine = StructType([f for f in union_schema(old, schema, sensitive).fields if resolve(f.name, schema.fieldNames(), sensitive)])
        align(spark.createDataFrame([], schema), mine)
        new = [f for f in plain if resolve(f.name, old.fieldNames(), sensitive) is None]
        if new:
            spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(map(ddl, new))})")

    def _spec(self, day: str) -> str:
        return f"PARTITION ({quote(self.partition_column)} = DATE'{dt.date.fromisoformat(day).isoformat()}')"

    def _switch(self, spark: SparkSession, run: str, written: list[str], gone: list[str], everything: bool = False) -> None:
        """Point the catalog at the run's folders, drop the dates in ``gone``, and remove what the run
        before this one had replaced."""
        table, there = self._table(spark), self._dates(spark)
        name = run.rsplit("/", 1)[-1]
        stay = [d for d in written if d in there]
        # a run that replaces every date retires all runs before it, by name
        retired = [] if everything else [self._folder(spark, d) for d in [*stay, *(d for d in gone if d in there)]]
        before = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
        for d in stay:
            spark.sql(f"ALTER TABLE {table} {self._spec(d)} SET LOCATION '{self._at(run, d)}'")
        fresh = [f"{self._spec(d)} LOCATION '{self._at(run, d)}'" for d in written if d not in there]
        for i in range(0, len(fresh), _AT_ONCE):
            spark.sql(f"ALTER TABLE {table} ADD {' '.join(fresh[i : i + _AT_ONCE])}")
        for d in gone:
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {self._spec(d)}")
        for folder in filter(None, before.get(_RETIRED, "").split(",")):
            fs.delete(spark, f"{self.location.rstrip('/')}/{folder}")
        for e in fs.list_dir(spark, self.location) if before.get(_SINCE) else []:
            if e.is_dir and e.name.startswith("run-") and e.name < before[_SINCE]:
                fs.delete(spark, e.path)
        since = name if everything else ""
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{_RETIRED}' = '{','.join(retired)}', '{_SINCE}' = '{since}')")

    def _at(self, run: str, day: str) -> str:
        return f"{run}/{self.partition_column}={day}"

    def _folder(self, spark: SparkSession, day: str) -> str:
        """Where a date lies, below the table's location."""
        rows = spark.sql(f"DESCRIBE TABLE EXTENDED {self._table(spark)} {self._spec(day)}").collect()
        where = next(r["data_type"] for r in rows if r["col_name"] == "Location")
        return "/".join(where.rstrip("/").rsplit("/", 2)[-2:])
