"""Current-state table: one row per key, as a view over bucketed catalog tables (K4, K5, K6).

Each build is a catalog table of its own, ``<view>__build_<number>``, bucketed by the key with Spark's
``bucketBy``. The view is replaced to point at a build when it is complete, which is the only commit: a
build that fails leaves the view, and what it shows, as they were. Readers that opened the view before
keep the build that they opened; the ``keep`` builds before the live one stay for them.

* Upsert (K4): the live build is the merge's target. Its bucketing is the join's partitioning and that of
  the new build, so target rows are never shuffled: only the deduplicated updates are, once, and each
  task merges and writes one bucket.
* Reload (K5) and the first run (K6: the target need not exist) write the deduplicated updates alone.
* Which history dates a build has absorbed is a small table beside it, ``<build>_dates``.

The catalog must outlive the session where runs are separate processes (a metastore); within one session
Spark's own suffices. Runs on one table must not overlap.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quayside.errors import ContractError, NoNewData
from quayside.functions.names import col, quote
from quayside.operators.latest import ROW_HASH, latest_per_key
from quayside.operators.profile import metrics_of
from quayside.operators.upsert import NULL_KEY_POLICIES, upsert
from quayside.session import session_conf
from quayside.sinks.views import create_view, owned_table, split_name
from quayside.sources import fs

BUCKET_BYTES = 1 << 30  # what a bucket should hold where their number is derived
BUCKETS_AT_MOST = 65_536
DATES = "_dates"
_KEY, _BUCKETS = "quayside.key", "quayside.buckets"


@dataclass(frozen=True)
class Build:
    """A catalog table that a view shows."""

    table: str
    number: int
    key: str
    buckets: int


@dataclass(frozen=True)
class CurrentStateTable:
    """``name``: the view, with or without its database. ``location``: folder for the builds' files, by
    default the catalog's warehouse."""

    name: str
    key: str = "id"
    order: str = "ingestion_date"
    num_buckets: int = 64  # 0: of the live build; at a reload, from the estimated size of the rows
    tiebreak: object = ROW_HASH
    location: str | None = None
    max_records_per_file: int | None = None
    on_null_key: str = "keep"  # or "drop", "fail"
    keep: int = 1  # builds before the live one that stay

    # -- the live build -----------------------------------------------------------
    def live(self, spark: SparkSession) -> Build | None:
        """The build that the view shows; None without a view."""
        owned = owned_table(spark, self.name)
        if owned is None:
            return None
        table, properties = owned
        number = re.search(r"__build_(\d+)`?$", table)
        if number is None or _KEY not in properties:
            raise ContractError(f"{self.name} is a view of another kind, no current state")
        return Build(table, int(number.group(1)), properties[_KEY], int(properties[_BUCKETS]))

    def exists(self, spark: SparkSession) -> bool:
        return self.live(spark) is not None

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.table(self._opened(spark).table)

    def schema(self, spark: SparkSession) -> StructType:
        return self.read(spark).schema

    def _opened(self, spark: SparkSession) -> Build:
        live = self.live(spark)
        if live is None:
            raise FileNotFoundError(f"no current state named {self.name}")
        return live

    def builds(self, spark: SparkSession) -> dict[int, str]:
        """Number and table of every build that the catalog has, the live one among them."""
        db, view = split_name(spark, self.name)
        rows = spark.sql(f"SHOW TABLES IN {db} LIKE '{view}__build_*'").collect()
        found = [(re.fullmatch(re.escape(view) + r"__build_(\d+)", r["tableName"], re.I), r["tableName"]) for r in rows]
        return {int(m.group(1)): f"{db}.{quote(t)}" for m, t in found if m}

    def absorbed(self, spark: SparkSession) -> dict[str, str] | None:
        """Version of each history date that the live build holds; None if that is not known."""
        live = self.live(spark)
        table = _beside(live.table) if live else None
        if table is None or not spark.catalog.tableExists(table):
            return None
        return {r["date"]: r["version"] for r in spark.table(table).collect()}  # a row for each date

    # -- writes -------------------------------------------------------------------
    def deduped(self, updates: DataFrame) -> DataFrame:
        """Latest row per key; null keys, which are one group here, by the table's rule."""
        if self.on_null_key not in NULL_KEY_POLICIES:
            raise ValueError(f"on_null_key must be one of {NULL_KEY_POLICIES}")
        k = col(self.key)
        if self.on_null_key == "drop":
            updates = updates.where(k.isNotNull())
        elif self.on_null_key == "fail":
            updates = updates.withColumn(
                self.key, F.when(k.isNull(), F.raise_error(F.lit(f"null {self.key} in updates"))).otherwise(k))
        return latest_per_key(updates, [self.key], [self.order], self.tiebreak)

    @staticmethod
    def settings(buckets: int) -> dict[str, str]:
        """Under these the shuffle that deduplicates updates deals them as the buckets are dealt, and a
        join on key and null-key salt takes rows that are dealt by the key alone. Null keys, which would
        meet in one bucket, come once a run."""
        return {"spark.sql.shuffle.partitions": str(buckets), "spark.sql.requireAllClusterKeysForCoPartition": "false"}

    def merge_frame(self, spark: SparkSession, deduped: DataFrame) -> DataFrame:
        """The rows of the live build merged with ``deduped`` updates (K4 rules)."""
        return upsert(spark.table(self._opened(spark).table), deduped, self.key, self.order, dedupe=False)

    def upsert(self, spark: SparkSession, updates: DataFrame, absorbed: dict[str, str] | None = None) -> dict:
        """Merge ``updates`` into the state; creates it on first use. ``absorbed``: the history dates that
        the new build holds. Raises :class:`NoNewData` without update rows, with the state as it was.

        With ``on_null_key="keep"`` each run with a null-key row inserts it, also when it is run again: null
        keys match nothing."""
        live = self.live(spark)
        if live is None:
            return {"created": True, **self.reload(spark, updates, absorbed)}
        if live.key != self.key:
            raise ContractError(f"{self.name} is kept by key {live.key!r}, not {self.key!r}; reload it to change the key")
        buckets = self.num_buckets or live.buckets
        with session_conf(spark, self.settings(buckets)):
            staged = Observation("current_updates")
            rows = self.deduped(updates).observe(staged, F.count(F.lit(1)).alias("n"))
            metrics = self._build(spark, self.merge_frame(spark, rows), live, buckets, absorbed, staged)
        return {"created": False, **metrics}

    def reload(self, spark: SparkSession, updates: DataFrame, absorbed: dict[str, str] | None = None) -> dict:
        """Publish the deduplicated ``updates`` as the whole state; key and number of buckets may change."""
        live = self.live(spark)
        buckets = self.num_buckets or _derived_buckets(updates)
        with session_conf(spark, self.settings(buckets)):
            staged = Observation("current_updates")
            rows = self.deduped(updates).observe(staged, F.count(F.lit(1)).alias("n"))
            return self._build(spark, rows, live, buckets, absorbed, staged)

    def _build(self, spark: SparkSession, rows: DataFrame, live: Build | None, buckets: int,
               absorbed: dict[str, str] | None, staged: Observation) -> dict:
        """Write ``rows`` as the next build and let the view show it."""
        db, view = split_name(spark, self.name)
        number = max([0, *self.builds(spark)]) + 1
        build = Build(f"{db}.{quote(f'{view}__build_{number:06d}')}", number, self.key, buckets)
        written = Observation("current_build")
        counted = rows.observe(written, F.count(F.lit(1)).alias("n"))
        try:
            self._save(counted, build.table, buckets)
            updates = metrics_of(staged, n=0)["n"]
            if not updates:
                raise NoNewData("no update rows")
            if absorbed is not None:
                self._save(spark.createDataFrame(sorted(absorbed.items()), "date string, version string").coalesce(1),
                           _beside(build.table))
            columns = ", ".join(quote(c) for c in rows.columns)
            create_view(spark, self.name, f"SELECT {columns} FROM {build.table}", build.table,
                        {_KEY: self.key, _BUCKETS: str(buckets)})
        except BaseException:
            self._drop(spark, build.table)  # the view never showed it
            raise
        shown = sorted(n for n in self.builds(spark) if n < number)
        for old in shown[: len(shown) - self.keep]:
            self._drop(spark, f"{db}.{quote(f'{view}__build_{old:06d}')}")
        return {"build": number, "num_buckets": buckets, "rows_updates": updates, "rows_written": metrics_of(written, n=0)["n"]}

    def _files(self, table: str) -> str | None:
        name = table.rsplit(".", 1)[-1].strip("`")
        return f"{self.location.rstrip('/')}/{name}" if self.location else None

    def _save(self, rows: DataFrame, table: str, buckets: int | None = None) -> None:
        w = rows.write.format("parquet").mode("overwrite")
        if self.location:
            w = w.option("path", self._files(table))
        if buckets:
            w = w.bucketBy(buckets, self.key)
            if self.max_records_per_file:
                w = w.option("maxRecordsPerFile", self.max_records_per_file)
        w.saveAsTable(table)

    def _drop(self, spark: SparkSession, table: str) -> None:
        for t in (table, _beside(table)):
            spark.sql(f"DROP TABLE IF EXISTS {t}")
            if self.location:
                fs.delete(spark, self._files(t))


def _beside(table: str) -> str:
    """The table of absorbed dates beside a build."""
    return f"{table[:-1]}{DATES}`" if table.endswith("`") else f"{table}{DATES}"


def _derived_buckets(updates: DataFrame) -> int:
    """Buckets of about ``BUCKET_BYTES``, by the planner's estimate of the rows (no job runs)."""
    estimate = int(str(updates._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(64, min(BUCKETS_AT_MOST, -(-estimate // BUCKET_BYTES)))
