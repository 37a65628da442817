"""Physical-plan properties the scale design relies on."""

import datetime as dt
import re
from pathlib import Path

from quayside.functions.dates import in_dates
from quayside.operators.latest import latest_per_key
from quayside.operators.upsert import upsert
from quayside.plans.history_ingest import history_frame

D = dt.date
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "PythonUDF")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_history_batch_needs_no_shuffle(spark, landing):
    root = landing({"20240101/a.json": {"Data": [{"id": 1, "n": {"a": 2}}]},
                    "20240102/b.json": {"Data": [{"id": 2}]}})
    rows = history_frame(spark, [f"{root}/feed/20240101", f"{root}/feed/20240102"])
    p = plan(rows.where(in_dates("ingestion_date", {"20240102"})))
    assert "Exchange" not in p and "Generate" in p


def test_upsert_dedupes_updates_map_side_and_joins_on_salted_key(spark):
    schema = "id long, ingestion_date date, v string"
    t = spark.createDataFrame([(1, D(2024, 1, 1), "a")], schema)
    u = spark.createDataFrame([(1, D(2024, 1, 2), "b")], schema)
    p = plan(upsert(t, u))
    assert re.search(r"WindowGroupLimit .*Partial", p)
    assert re.search(r"hashpartitioning\(__k#\d+L?, __s#\d+", p)


def test_latest_per_key_with_row_hash_tiebreak_keeps_partial_limit(spark):
    df = spark.createDataFrame([(1, D(2024, 1, 1), "a")], "id long, ingestion_date date, v string")
    assert re.search(r"WindowGroupLimit .*Partial", plan(latest_per_key(df, ["id"])))


def test_no_python_execution_in_scenario_plans(spark):
    import __spark_entry__ as entry
    sf = "/root/testdata/sf0.001"
    for name in ("contract_cast", "utc_by_column", "upsert_current", "conform_nested", "profile_by_day",
                 "window_replace", "hot_key_upsert"):
        p = plan(entry.queries()[name](spark, sf))
        assert not any(node in p for node in PYTHON_NODES), name


def test_library_has_no_udfs_or_rdds():
    src = Path(__file__).resolve().parents[1] / "quayside"
    text = "\n".join(f.read_text() for f in src.rglob("*.py") if "llm" not in f.parts)
    for pattern in (r"\budf\(", r"pandas_udf", r"mapInPandas", r"applyInPandas", r"\.rdd\b", r"localCheckpoint"):
        assert not re.search(pattern, text), pattern


def test_hot_delivery_day_is_written_by_many_tasks(spark, tmp_path):
    import os

    from pyspark.sql import functions as F

    from quayside.plans.history_ingest import ingest_history
    from quayside.sinks.history import HistoryTable
    from quayside.sources.landing import LandingFeed
    from quayside.testing import write_deliveries
    # 2 Jan holds 90% of the rows
    data = [(i, D(2024, 1, 2)) for i in range(1800)] + [(2000 + i, D(2024, 1, 1 + 2 * (i % 2))) for i in range(200)]
    feed = LandingFeed(str(tmp_path / "landing"), "hot")
    write_deliveries(spark.createDataFrame(data, "id long, d date"), feed, F.col("d"), rows_per_document=300)
    history = HistoryTable(str(tmp_path / "h"))
    result = ingest_history(spark, feed, history, "all")
    assert result.ok and result.metrics["rows"] == 2000
    hot = os.path.join(history.path, "ingestion_date=2024-01-02")
    files = [f for f in os.listdir(hot) if f.endswith(".parquet")]
    assert len(files) >= 4  # one writer per landing document's task, no single hot writer
    assert history.read(spark, ["20240102"]).count() == 1800


def test_observed_profile_keeps_the_partial_group_limit(spark):
    from quayside.operators.profile import observed
    df = spark.createDataFrame([(1, D(2024, 1, 1), "a")], "id long, ingestion_date date, v string")
    rows, _ = observed(df, "profile_plan_check", "ingestion_date")
    p = plan(latest_per_key(rows, ["id"]))
    assert "CollectMetrics" in p and re.search(r"WindowGroupLimit .*Partial", p)
