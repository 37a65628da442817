"""End-to-end scenarios over the shared test tables, one per operator group.

Each scenario takes ``(spark, sf_dir)``, reads the given parquet tables (all
rows), drives the library the way a user would, and returns a DataFrame whose
columns are named exactly like the matching DuckDB oracle query in
``__spark_entry__.py``. Clock and temp-path columns (``processing_time``,
``source_path``) are left out; timestamps are returned as ``timestamp_ntz``
(UTC wall clock) so the comparison does not depend on the reader's zone.

The ``events`` table is landed once per ``sf_dir`` as dated JSON deliveries,
and ingested once into a shared history table; both live in the cluster's
shared checkpoint folder and are reused by later scenarios (each scenario's
own writes go to a fresh folder).
"""

from __future__ import annotations

import datetime as dt
import hashlib
import os
from dataclasses import replace
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.errors import ContractError, NoNewData, Outcome
from quayside.functions.dates import lookback_window as window_of
from quayside.functions.names import col
from quayside.functions.nested import is_struct_like, nested_to_json
from quayside.operators.latest import latest_per_key
from quayside.operators.profile import distribution, profile
from quayside.operators.lineage import stamp_run
from quayside.operators.project import all_as_text, apply_contract, conform_to_schema, select_columns
from quayside.operators.upsert import upsert
from quayside.plans.contract import Contract
from quayside.plans.current_state import build_current_state, current_frame
from quayside.plans.history_ingest import history_frame, ingest_history
from quayside.session import configure, new_scratch_path, scratch_path
from quayside.sinks.current import CurrentStateTable
from quayside.sinks.evolve import insert_evolving
from quayside.sinks.history import HistoryTable, replace_window_frame
from quayside.sinks.history_catalog import CatalogHistoryTable
from quayside.sinks.views import publish_current, publish_over, publish_view, view_name
from quayside.sources import fs
from quayside.sources.json_feed import infer_envelope_schema
from quayside.sources.landing import LandingFeed
from quayside.streaming.landing_stream import ingest_arrivals
from quayside.testing import write_deliveries

# Bump when the landed fixture's shape changes (landing_records / write_deliveries),
# so cached fixtures from an older layout are not reused.
CACHE_VERSION = "v3"
_cache_token = ""


def use_fresh_fixtures(token: str) -> None:
    """Make later scenarios rebuild the shared landing/history fixtures under ``token``."""
    global _cache_token
    _cache_token = token


DATASET = "events"
UPDATE_TYPES = ("purchase", "error")  # the second feed in the upsert scenarios


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _require(ok: bool, what: object) -> None:
    if not ok:
        raise RuntimeError(f"scenario step failed: {what}")


def _cache_dir(spark: SparkSession, sf_dir: str) -> str:
    """A folder that belongs to the events table as it is now: its files' names, sizes and times."""
    files = fs.fingerprint(spark, f"{sf_dir.rstrip('/')}/events.parquet")
    key = hashlib.sha1(f"{files}|{CACHE_VERSION}|{_cache_token}".encode()).hexdigest()[:12]
    return scratch_path(spark, "cache", key)


def _ntz(c: str):
    return col(c).cast("timestamp_ntz").alias(c)


# -- shared fixtures ------------------------------------------------------------

def landing_records(events: DataFrame) -> DataFrame:
    """``events`` as the records of a delivery: ids as numbers, time as text, nested props."""
    return events.select(
        col("event_id").alias("id"), "user_id", "event_type", "value",
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"),
        F.date_format("ts", "dd/MM/yyyy").alias("day"),
        F.from_json("props", "k int").alias("props"),
        F.array(F.struct(col("value").alias("amount"), col("event_type").alias("kind"))).alias("lines"),
    )


def landed_events(spark: SparkSession, sf_dir: str) -> LandingFeed:
    """All of ``events`` landed as ``<root>/events/<yyyyMMdd>/`` deliveries (cached)."""
    root = _cache_dir(spark, sf_dir)
    feed = LandingFeed(f"{root}/landing", DATASET)
    marker = f"{root}/_LANDED"
    if fs.read_text(spark, marker) is None:
        if fs.exists(spark, feed.path):
            fs.delete(spark, feed.path)
        events = _table(spark, sf_dir, "events")
        write_deliveries(landing_records(events), feed, F.to_date("ts"))
        fs.write_text(spark, marker, "ok")
    return feed


def ingested_history(spark: SparkSession, sf_dir: str) -> HistoryTable:
    """History table holding every landed delivery (cached)."""
    root = _cache_dir(spark, sf_dir)
    history = HistoryTable(f"{root}/history")
    marker = f"{root}/_INGESTED"
    if fs.read_text(spark, marker) is None:
        result = ingest_history(spark, landed_events(spark, sf_dir), history, "all")
        if result.outcome is not Outcome.SUCCESS:
            raise RuntimeError(f"history fixture failed: {result}")
        fs.write_text(spark, marker, "ok")
    return history


def _history_view(df: DataFrame) -> DataFrame:
    """History rows in comparison form (value back to double, lineage clock dropped)."""
    return df.select("id", "user_id", "event_type", "ts", col("value").cast("double").alias("value"),
                     "props", "ingestion_date")


# -- scenarios --------------------------------------------------------------------

def feed_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every delivery folder -> a new history table."""
    configure(spark)
    feed = landed_events(spark, sf_dir)
    history = HistoryTable(new_scratch_path(spark, "feed-ingest"))
    result = ingest_history(spark, feed, history, "all")
    _require(result.ok, result)
    return _history_view(history.read(spark))


def feed_ingest_rebalanced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``feed_ingest``, written through one AQE-sized shuffle by date
    (the layout option for feeds of many small documents); same rows."""
    configure(spark)
    feed = landed_events(spark, sf_dir)
    history = HistoryTable(new_scratch_path(spark, "feed-ingest-rebalanced"))
    result = ingest_history(spark, feed, history, "all", rebalance=True)
    _require(result.ok, result)
    return _history_view(history.read(spark))


def lookback_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request 10 and 15 Jan; their previous days come along."""
    configure(spark)
    feed = landed_events(spark, sf_dir)
    history = HistoryTable(new_scratch_path(spark, "lookback"))
    result = ingest_history(spark, feed, history, "20240110,20240115")
    _require(result.ok, result)
    return history.read(spark).select("id", "ingestion_date")


def latest_per_key_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest event per user (by day, then event id)."""
    configure(spark)
    events = _table(spark, sf_dir, "events").withColumn("ingestion_date", F.to_date("ts"))
    latest = latest_per_key(events, ["user_id"], ["ingestion_date"], tiebreak=["event_id"])
    return latest.select("user_id", "event_id", "ingestion_date", "value")


def hot_key_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 K4 with hot keys: state per event type (5 keys, each about a fifth of all rows).

    The first half of the month builds the state, the second half is merged
    into it; each map task forwards one row per key, so no reducer receives a
    hot key's rows.
    """
    configure(spark)
    rows = _table(spark, sf_dir, "events").select(
        "event_type", F.to_date("ts").alias("ingestion_date"), "event_id", "value")
    early = col("ingestion_date") <= F.lit("2024-01-15").cast("date")
    state = latest_per_key(rows.where(early), ["event_type"], ["ingestion_date"], tiebreak=["event_id"])
    return upsert(state, rows.where(~early), key="event_type", order="ingestion_date", tiebreak=["event_id"])


def _user_state(events: DataFrame) -> DataFrame:
    return events.select("user_id", F.to_date("ts").alias("ingestion_date"), "event_id", "value", "event_type")


def _feeds(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = _user_state(_table(spark, sf_dir, "events"))
    is_update = col("event_type").isin(list(UPDATE_TYPES))
    return rows.where(~is_update), rows.where(is_update)


def upsert_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-user state from one feed, upserted with the other feed."""
    configure(spark)
    first, second = _feeds(spark, sf_dir)
    target = latest_per_key(first, ["user_id"], ["ingestion_date"], tiebreak=["event_id"])
    return upsert(target, second, key="user_id", order="ingestion_date", tiebreak=["event_id"])


def window_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 (frame form): a corrected 3 Jan re-delivery; 2 Jan is in the window but absent."""
    configure(spark)
    events = _table(spark, sf_dir, "events").select(
        col("event_id").alias("id"), F.to_date("ts").alias("ingestion_date"), "value")
    correction = events.where(col("ingestion_date") == F.lit("2024-01-03").cast("date")) \
        .withColumn("value", col("value") * 2)
    return replace_window_frame(events, correction, {"20240102", "20240103"})


def window_replace_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 on the table, replayed twice: 3 Jan replaced, 2 Jan emptied, others untouched."""
    configure(spark)
    return _window_replaced(spark, sf_dir, HistoryTable(new_scratch_path(spark, "window-table")))


def window_replace_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 K8 as ``window_replace_table``, each date switched in the catalog; read through a view that was
    made before the replacements."""
    configure(spark)
    history = _catalog_history(spark, "window-catalog")
    _window_replaced(spark, sf_dir, history)
    return spark.table(f"{history.name}_shown").select("id", "ingestion_date", col("value").cast("double").alias("value"))


def _catalog_history(spark: SparkSession, label: str) -> CatalogHistoryTable:
    location = new_scratch_path(spark, label)
    return CatalogHistoryTable("quayside_" + os.path.basename(location).replace("-", "_"), location)


def full_replace_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2 in the catalog: the second publication replaces every date of the first."""
    configure(spark)
    events = _table(spark, sf_dir, "events").select(
        col("event_id").alias("id"), F.to_date("ts").alias("ingestion_date"), "value")
    history = _catalog_history(spark, "full-catalog")
    history.replace_all(events.withColumn("ingestion_date", F.date_add("ingestion_date", -1)))
    history.replace_all(events.withColumn("value", col("value") * 2))
    return history.read(spark).select("id", "ingestion_date", "value")


def history_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2 of a history run: volume and freshness observed on its write, and the distribution of its rows."""
    configure(spark)
    result = ingest_history(spark, landed_events(spark, sf_dir), HistoryTable(new_scratch_path(spark, "profiled")), "all",
                            freshness_column="ts", distribution_column="event_type")
    _require(result.ok, result)
    m = result.metrics
    return m["distribution"].select("event_type", col("count").alias("n"), F.lit(m["volume"]).cast("long").alias("volume"),
                                    F.lit(m["freshness"]).alias("freshness"))


def _window_replaced(spark: SparkSession, sf_dir: str, history: HistoryTable | CatalogHistoryTable) -> DataFrame:
    base = landed_events(spark, sf_dir)
    result = ingest_history(spark, base, history, "all")
    _require(result.ok, result)
    if isinstance(history, CatalogHistoryTable):
        publish_over(spark, f"{history.name}_shown", history.name)
    events = _table(spark, sf_dir, "events")
    corrected = LandingFeed(new_scratch_path(spark, "landing-v2"), DATASET)
    day3 = events.where(F.to_date("ts") == F.lit("2024-01-03").cast("date")).withColumn("value", col("value") * 2)
    write_deliveries(landing_records(day3), corrected, F.to_date("ts"))
    for _ in range(2):
        result = ingest_history(spark, corrected, history, "20240103")
        _require(result.ok and result.metrics["dates_emptied"] == ["2024-01-02"], result)
    return history.read(spark).select("id", "ingestion_date", col("value").cast("double").alias("value"))


EVENTS_CONTRACT = {
    "origin_conf": {"type": "struct", "fields": [
        {"name": "id", "type": "string"}, {"name": "user_id", "type": "string"},
        {"name": "event_type", "type": "string"}, {"name": "ts", "type": "string"},
        {"name": "value", "type": "string"}, {"name": "day", "type": "string"},
        {"name": "props", "type": {"type": "struct", "fields": [
            {"name": "k", "type": "integer"}, {"name": "absent", "type": "string"}]}},
        {"name": "lines", "type": {"type": "array", "containsNull": True, "elementType": {
            "type": "struct", "fields": [{"name": "amount", "type": "double"},
                                         {"name": "kind", "type": "string"},
                                         {"name": "absent", "type": "integer"}]}}},
        {"name": "missing", "type": "double"},
    ]},
    "fields": [
        {"name": "id", "source_name": "id", "type": "long"},
        {"name": "label", "expression": "concat(event_type, '-', user_id)", "type": "string"},
        {"name": "p", "expression": "props.k", "type": "integer"},
        {"name": "day", "source_name": "day", "type": "date",
         "metadata": {"date_definition": {"source_format": {"type": "string", "date_format": "dd/MM/yyyy"}}}},
        {"name": "amount", "source_name": "value", "type": "decimal(12,2)"},
        {"name": "absent", "source_name": "missing", "type": "double"},
    ],
}


def contract_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expression, rename, int from JSON text, date by pattern, decimal, absent."""
    configure(spark)
    contract = Contract.from_dict(EVENTS_CONTRACT)
    rows = ingested_history(spark, sf_dir).read(spark)
    return apply_contract(conform_to_schema(rows, contract.origin_schema), contract.fields)


def _ts_rule(name: str, source: str, zone: dict) -> dict:
    return {"name": name, "source_name": source, "type": "timestamp",
            "metadata": {"timestamp_definition": {"source_format": {"type": "string"}, "timezone": zone}}}


def utc_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event time text, wall clock in Paris -> UTC."""
    configure(spark)
    rows = ingested_history(spark, sf_dir).read(spark)
    fields = [{"name": "id", "source_name": "id", "type": "long"},
              _ts_rule("ts_utc", "ts", {"type": "literal", "value": "Europe/Paris"})]
    return apply_contract(rows, fields, keep=()).select("id", _ntz("ts_utc"))


ZONE_BY_STATUS = "CASE o_orderstatus WHEN 'F' THEN 'Europe/Paris' WHEN 'O' THEN 'America/New_York' " \
                 "WHEN 'P' THEN 'Asia/Tokyo' END"


def utc_by_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order time text, zone taken per row from a column."""
    configure(spark)
    orders = _table(spark, sf_dir, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("order_time"),
        F.expr(ZONE_BY_STATUS).alias("zone"))
    fields = [{"name": "o_orderkey", "source_name": "o_orderkey", "type": "long"},
              _ts_rule("order_utc", "order_time", {"type": "field", "value": "zone"})]
    return apply_contract(orders, fields, keep=()).select("o_orderkey", _ntz("order_utc"))


def profile_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: volume, freshness, null count, min and max of ``value`` per delivery day."""
    configure(spark)
    events = _table(spark, sf_dir, "events").withColumn("ingestion_date", F.to_date("ts"))
    out = profile(events, by=["ingestion_date"], freshness_column="ts", columns=["value"])
    return out.select("ingestion_date", "volume", _ntz("freshness"), "null_value", "min_value", "max_value")


def profile_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: value distribution of ``event_type``."""
    configure(spark)
    return distribution(_table(spark, sf_dir, "events"), "event_type").withColumnRenamed("count", "volume")


def _split_batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    events = _table(spark, sf_dir, "events").select(
        col("event_id").alias("id"), "user_id", "event_type", "value", "props",
        F.to_date("ts").alias("ingestion_date"))
    early = col("ingestion_date") <= F.lit("2024-01-15").cast("date")
    return events.where(early).drop("props"), events.where(~early).drop("value")


EVOLVED_COLUMNS = ["id", "user_id", "event_type", "value", "props", "ingestion_date"]


def schema_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3 on a path table: the later batch drops ``value`` and adds ``props``."""
    configure(spark)
    first, second = _split_batches(spark, sf_dir)
    history = HistoryTable(new_scratch_path(spark, "evolve"))
    history.replace_all(first)
    days = [r[0].strftime("%Y%m%d") for r in second.select("ingestion_date").distinct().collect()]
    history.replace_window(second, days)
    return history.read(spark).select(*EVOLVED_COLUMNS)


def schema_evolution_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3 on a catalog table: ``ALTER TABLE ADD COLUMNS`` then insert by name."""
    configure(spark)
    first, second = _split_batches(spark, sf_dir)
    path = new_scratch_path(spark, "evolve-table")
    name = "quayside_evolve_" + os.path.basename(path).replace("-", "_")
    first.limit(0).write.partitionBy("ingestion_date").option("path", path).saveAsTable(name)
    insert_evolving(spark, name, first)
    insert_evolving(spark, name, second)
    return spark.table(name).select(*EVOLVED_COLUMNS)


def full_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: publish all events, then a corrected full delivery; only the second remains."""
    configure(spark)
    events = _table(spark, sf_dir, "events").select(
        col("event_id").alias("id"), F.to_date("ts").alias("ingestion_date"), "value")
    history = HistoryTable(new_scratch_path(spark, "full-replace"))
    history.replace_all(events)
    history.replace_all(events.withColumn("value", col("value") * 2))
    return history.read(spark)


def reload_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stale state is discarded by a reload; the view follows the new build."""
    configure(spark)
    rows = _user_state(_table(spark, sf_dir, "events")).drop("event_type")
    table = _current(spark, "reload")
    table.upsert(spark, rows.withColumn("value", -col("value")))
    table.reload(spark, rows)
    name = view_name("silver", "standardized", table.name, DATASET)
    publish_current(spark, name, table, persistent=True)
    return spark.table(name)


def conform_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON-text struct and array-of-struct rebuilt to declared, typed shapes."""
    configure(spark)
    contract = Contract.from_dict(EVENTS_CONTRACT)
    rows = conform_to_schema(ingested_history(spark, sf_dir).read(spark), contract.origin_schema)
    first_line = F.element_at("lines", 1)
    return rows.select(col("id").cast("long").alias("id"),
                       F.col("props.k").alias("k"), F.col("props.absent").alias("absent"),
                       F.size("lines").alias("n_lines"),
                       first_line.getField("amount").alias("amount"),
                       first_line.getField("kind").alias("kind"),
                       first_line.getField("absent").alias("line_absent"))


def _current(spark: SparkSession, label: str, **options) -> CurrentStateTable:
    """A new current state by user, its files in the scratch folder."""
    location = new_scratch_path(spark, label)
    name = "quayside_" + os.path.basename(location).replace("-", "_")
    return CurrentStateTable(name, key="user_id", tiebreak=["event_id"], location=location, **{"num_buckets": 8, **options})


def _bucketed_upserts(spark: SparkSession, sf_dir: str, then_buckets: int) -> DataFrame:
    first, second = _feeds(spark, sf_dir)
    table = _current(spark, "bucketed")
    table.upsert(spark, first)
    for _ in range(2):
        replace(table, num_buckets=then_buckets).upsert(spark, second)
    return table.read(spark)


def upsert_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4 K6 on a bucketed catalog table: create from one feed, merge the other twice (replay)."""
    configure(spark)
    return _bucketed_upserts(spark, sf_dir, 8)


def upsert_bucketed_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4 K6 as ``upsert_bucketed``, merged into another number of buckets, which shuffles the target once."""
    configure(spark)
    return _bucketed_upserts(spark, sf_dir, 12)


CURRENT_CONTRACT = {
    "origin_conf": {"type": "struct", "fields": [
        {"name": "id", "type": "string"}, {"name": "user_id", "type": "string"},
        {"name": "ts", "type": "string"}, {"name": "value", "type": "string"}]},
    "fields": [
        {"name": "user_id", "source_name": "user_id", "type": "long"},
        {"name": "event_id", "source_name": "id", "type": "long"},
        {"name": "amount", "source_name": "value", "type": "decimal(12,2)"},
        _ts_rule("event_time", "ts", {"type": "literal", "value": "UTC"}),
    ],
}


def current_state_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full history -> contract -> reload, then a replayed upsert."""
    configure(spark)
    history = ingested_history(spark, sf_dir)
    contract = Contract.from_dict(CURRENT_CONTRACT)
    target = _current(spark, "current")
    view = target.name + "_shown"
    for reload in (True, False):
        run = build_current_state(spark, history, contract, target, reload=reload, view=view)
        _require(run.ok, run)
    return spark.table(view).select("user_id", "event_id", "amount", _ntz("event_time"), "ingestion_date")


def current_state_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4 S6 P7 P8 W1 K4 K5, incremental: the state is rebuilt from the deliveries of 1-28 Jan,
    then the daily run for 30 Jan reads only its look-back window (29 and 30 Jan) of the
    history table. Together the two runs cover every day."""
    configure(spark)
    history = ingested_history(spark, sf_dir)
    contract = Contract.from_dict(CURRENT_CONTRACT)
    target = _current(spark, "current-daily")
    rebuild = [f"202401{d:02d}" for d in range(1, 29)]
    first = build_current_state(spark, history, contract, target, reload=True, dates=rebuild)
    _require(first.ok, first)
    daily = build_current_state(spark, history, contract, target, dates=sorted(window_of("20240130")))
    _require(daily.ok, daily)
    return target.read(spark).select("user_id", "event_id", "amount", _ntz("event_time"), "ingestion_date")


def current_state_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S6 K4 from changed dates: a history of 1-28 Jan and its current state, then the
    30 Jan delivery (window 29-30 Jan) and a change-driven run that reads only those dates."""
    configure(spark)
    feed = landed_events(spark, sf_dir)
    history = HistoryTable(new_scratch_path(spark, "history-changed"))
    result = ingest_history(spark, feed, history, ",".join(f"202401{d:02d}" for d in range(1, 29)))
    _require(result.ok, result)
    contract = Contract.from_dict(CURRENT_CONTRACT)
    target = _current(spark, "current-changed")
    run = build_current_state(spark, history, contract, target, changed_only=True)  # nothing absorbed yet: full read
    _require(run.ok, run)
    result = ingest_history(spark, feed, history, "20240130")
    _require(result.ok, result)
    run = build_current_state(spark, history, contract, target, changed_only=True)
    _require(run.ok and run.metrics["history_dates"] == ["20240129", "20240130"], run)
    return target.read(spark).select("user_id", "event_id", "amount", _ntz("event_time"), "ingestion_date")


def latest_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the newest landing file (greatest path) is read and flattened."""
    configure(spark)
    feed = landed_events(spark, sf_dir)
    newest = feed.latest_file(spark)
    return history_frame(spark, newest).select("id", "ingestion_date")


def recursive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dataset folder scanned recursively (every day folder at once)."""
    configure(spark)
    feed = landed_events(spark, sf_dir)
    return _history_view(history_frame(spark, [feed.path], recursive=True))


def arrival_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streaming file-arrival ingest: every delivery day found by the stream, windowed replace."""
    configure(spark)
    feed = landed_events(spark, sf_dir)
    history = HistoryTable(new_scratch_path(spark, "arrivals"))
    outcomes = []
    query = ingest_arrivals(spark, feed, history, checkpoint=new_scratch_path(spark, "arrivals-ckpt"),
                            on_result=lambda days, result: outcomes.append(result.outcome))
    query.awaitTermination()
    _require(bool(outcomes) and all(o is Outcome.SUCCESS for o in outcomes), outcomes)
    return _history_view(history.read(spark))


def latest_file_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The day of the newest landing file, however the day was split into files."""
    return latest_file(spark, sf_dir).select("ingestion_date").distinct()


def missing_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requested days without a folder, or with an empty one, are skipped: no event has 31 Dec or
    31 Jan, and the folder of 31 Jan is made but empty."""
    configure(spark)
    source = landed_events(spark, sf_dir)
    feed = LandingFeed(new_scratch_path(spark, "gaps"), DATASET)
    events = _table(spark, sf_dir, "events")
    write_deliveries(landing_records(events), feed, F.to_date("ts"))
    fs.make_dir(spark, feed.folder("20240131"))
    _require(source.path != feed.path, "a feed of its own")
    history = HistoryTable(new_scratch_path(spark, "gaps-history"))
    days = ",".join(["20231231", *(f"202401{d:02d}" for d in range(1, 32))])
    result = ingest_history(spark, feed, history, days)
    _require(result.ok and result.metrics["folders"] == 30, result)
    return history.read(spark).select("id", "ingestion_date")


def starting_from(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the days of 9 to 12 Jan are requested, the run starts from 11 Jan; the window of the
    remaining days reaches back to 10 Jan."""
    configure(spark)
    history = HistoryTable(new_scratch_path(spark, "starting-from"))
    result = ingest_history(spark, landed_events(spark, sf_dir), history, "20240109,20240110,20240111,20240112",
                            starting_from="20240111")
    _require(result.ok, result)
    return history.read(spark).select("id", "ingestion_date")


def struct_like_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structs and arrays of structs become JSON text, arrays of scalars stay arrays."""
    configure(spark)
    rows = _table(spark, sf_dir, "events").select(
        "event_id", F.from_json("props", "k int").alias("props"), F.array("event_type").alias("tags"),
        F.array(F.struct(col("event_id").alias("n"))).alias("lines"))
    out = nested_to_json(rows, is_struct_like)
    return out.select("event_id", "props", F.element_at("tags", 1).alias("tag"), "lines")


def run_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One stamp for a whole run, whatever the rows: rows and distinct stamps."""
    configure(spark)
    at = dt.datetime(2024, 2, 1, 12, 30, tzinfo=dt.timezone.utc)
    rows = stamp_run(_table(spark, sf_dir, "events"), at)
    return rows.groupBy(_ntz("processing_time")).agg(F.count("*").alias("n"))


def project_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5: a projection to names, one of which the rows do not have."""
    configure(spark)
    return select_columns(_table(spark, sf_dir, "events"), ["event_id", "not_there", "event_type"])


def all_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every data column as text, the lineage column with its type."""
    configure(spark)
    rows = _table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "props",
                                                  F.to_date("ts").alias("ingestion_date"))
    return all_as_text(rows)


def guards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How runs and contracts that cannot go on end, beside the rows of a history that
    each of them leaves as it was."""
    configure(spark)
    feed, root = landed_events(spark, sf_dir), new_scratch_path(spark, "guards")
    history = HistoryTable(f"{root}/history")
    result = ingest_history(spark, feed, history, "all")
    _require(result.ok, result)
    odd = LandingFeed(f"{root}/landing", "odd")
    fs.write_text(spark, f"{odd.folder('20240105')}/a.json", "{}")
    with_schema = infer_envelope_schema(spark, [feed.folder("20240105")])
    contract = Contract.from_dict(CURRENT_CONTRACT)
    target = _current(spark, "guards-current", num_buckets=4)
    nothing = history.read(spark).where("false")
    outcomes = {
        "no folder": ingest_history(spark, feed, history, "20301231").outcome.value,
        "no envelope": ingest_history(spark, odd, history, "20240105").outcome.value,
        "no envelope, given schema": ingest_history(spark, odd, history, "all", schema=with_schema).outcome.value,
        "empty upsert": _outcome(lambda: target.upsert(spark, current_frame(nothing, contract))),
        "empty reload": _outcome(lambda: target.reload(spark, current_frame(nothing, contract))),
        "unsupported type": _outcome(lambda: apply_contract(nothing, [
            {"name": "m", "source_name": "id", "type": "map<string,string>"}])),
        "bad timezone kind": _outcome(lambda: apply_contract(nothing, [_ts_rule("t", "ts", {"type": "other"})])),
    }
    rows = spark.createDataFrame(list(outcomes.items()), "guard string, outcome string")
    left = history.read(spark).agg(F.count("*").alias("history_rows"))
    return rows.join(left, how="cross")  # one row on the right


def _outcome(f: Callable[[], object]) -> str:
    try:
        f()
    except NoNewData:
        return Outcome.NO_NEW_DATA.value
    except ContractError:
        return "CONTRACT_ERROR"
    return Outcome.SUCCESS.value


def full_replace_nothing_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: a rebuild without a usable row is refused and leaves the table as it was."""
    configure(spark)
    events = _table(spark, sf_dir, "events").select(
        col("event_id").alias("id"), F.to_date("ts").alias("ingestion_date"), "value")
    history = HistoryTable(new_scratch_path(spark, "refused"))
    history.replace_all(events)
    undated = events.withColumn("ingestion_date", F.lit(None).cast("date"))
    _require(_outcome(lambda: history.replace_all(undated)) == Outcome.NO_NEW_DATA.value, "refusal")
    return history.read(spark)


def window_replace_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 K7: an empty batch through the rebalanced layout empties the dates of its window."""
    configure(spark)
    events = _table(spark, sf_dir, "events").select(
        col("event_id").alias("id"), F.to_date("ts").alias("ingestion_date"), "value")
    history = HistoryTable(new_scratch_path(spark, "emptied"))
    history.replace_all(events)
    history.replace_window(events.where("false"), ["20240110", "20240111"], rebalance=True)
    return history.read(spark)


def persistent_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K8 over an evolved table: a view in the catalog has every column the table has had."""
    configure(spark)
    first, second = _split_batches(spark, sf_dir)
    history = HistoryTable(new_scratch_path(spark, "viewed"))
    history.replace_all(first)
    days = [r[0].strftime("%Y%m%d") for r in second.select("ingestion_date").distinct().collect()]
    history.replace_window(second, days)
    name = view_name("bronze", "raw", os.path.basename(history.path).replace("-", "_"), DATASET)
    publish_view(spark, name, history.path, persistent=True, schema=history.schema(spark),
                 partitions=[history.partition_column])
    return spark.table(name).select(*EVOLVED_COLUMNS)


SCENARIOS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "feed_ingest": feed_ingest,
    "feed_ingest_rebalanced": feed_ingest_rebalanced,
    "lookback_window": lookback_window,
    "latest_per_key": latest_per_key_events,
    "upsert_current": upsert_current,
    "window_replace": window_replace,
    "window_replace_table": window_replace_table,
    "window_replace_catalog": window_replace_catalog,
    "full_replace_catalog": full_replace_catalog,
    "history_profile": history_profile,
    "contract_cast": contract_cast,
    "utc_literal": utc_literal,
    "utc_by_column": utc_by_column,
    "profile_by_day": profile_by_day,
    "profile_distribution": profile_distribution,
    "schema_evolution": schema_evolution,
    "schema_evolution_table": schema_evolution_table,
    "full_replace": full_replace,
    "reload_current": reload_current,
    "conform_nested": conform_nested,
    "upsert_bucketed": upsert_bucketed,
    "upsert_bucketed_shuffle": upsert_bucketed_shuffle,
    "current_state_build": current_state_build,
    "current_state_daily": current_state_daily,
    "current_state_changed": current_state_changed,
    "latest_file": latest_file,
    "recursive_scan": recursive_scan,
    "arrival_ingest": arrival_ingest,
    "hot_key_upsert": hot_key_upsert,
    "latest_file_day": latest_file_day,
    "missing_folders": missing_folders,
    "starting_from": starting_from,
    "struct_like_text": struct_like_text,
    "run_stamp": run_stamp,
    "project_names": project_names,
    "all_text": all_text,
    "guards": guards,
    "full_replace_nothing_new": full_replace_nothing_new,
    "window_replace_empty": window_replace_empty,
    "persistent_view": persistent_view,
}
