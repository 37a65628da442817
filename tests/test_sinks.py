"""History table (K1 K2 K3) and views (K8)."""

import datetime as dt
import os

import pytest

from quayside.errors import NoNewData
from quayside.sinks.history import HistoryTable, replace_window_frame
from quayside.sinks.views import publish_view, view_location, view_name

D = dt.date


def history_rows(spark, rows):
    return spark.createDataFrame(rows, "id string, v string, ingestion_date date")


def test_window_replace_empties_absent_dates_and_is_replayable(spark, tmp_path):
    h = HistoryTable(str(tmp_path / "h"))
    h.replace_all(history_rows(spark, [(str(i), "old", D(2024, 1, i)) for i in range(1, 5)]))
    batch = history_rows(spark, [("3", "new", D(2024, 1, 3)), ("9", "late", D(2024, 1, 9))])
    for _ in range(2):
        m = h.replace_window(batch, {"20240102", "20240103"})
        assert m["dates_written"] == ["2024-01-03"] and m["dates_emptied"] == ["2024-01-02"]
        assert m["rows_rejected"] == 1
        got = sorted((r.id, r.v, r.ingestion_date) for r in h.read(spark).collect())
        assert got == [("1", "old", D(2024, 1, 1)), ("3", "new", D(2024, 1, 3)), ("4", "old", D(2024, 1, 4))]


def test_window_frame_form_matches_table(spark):
    hist = history_rows(spark, [(str(i), "old", D(2024, 1, i)) for i in range(1, 5)])
    batch = history_rows(spark, [("3", "new", D(2024, 1, 3))])
    got = sorted(tuple(r) for r in replace_window_frame(hist, batch, {"20240102", "20240103"}).collect())
    assert got == [("1", "old", D(2024, 1, 1)), ("3", "new", D(2024, 1, 3)), ("4", "old", D(2024, 1, 4))]


def test_history_read_prunes_partitions(spark, tmp_path):
    h = HistoryTable(str(tmp_path / "h"))
    h.replace_all(history_rows(spark, [(str(i), "x", D(2024, 1, i)) for i in range(1, 5)]))
    df = h.read(spark, dates=["20240102"])
    assert [r.id for r in df.collect()] == ["2"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingestion_date" in plan


def test_history_read_opens_only_the_window_partitions(spark, tmp_path):
    h = HistoryTable(str(tmp_path / "h"))
    h.replace_all(spark.createDataFrame([("1", "a", "old-only", D(2024, 1, 1))],
                                        "id string, v string, gone string, ingestion_date date"))
    h.replace_window(history_rows(spark, [("2", "b", D(2024, 1, 2)), ("3", "c", D(2024, 1, 3))]),
                     {"20240102", "20240103"})
    df = h.read(spark, dates=["20240103", "20240109"])  # 9 Jan has no partition
    assert all("ingestion_date=2024-01-03" in f for f in df.inputFiles()) and df.inputFiles()
    assert [(r.id, r.ingestion_date) for r in df.collect()] == [("3", D(2024, 1, 3))]
    assert "gone" in df.columns and dict(df.dtypes)["ingestion_date"] == "date"  # the stored schema has it
    assert "gone" in h.read(spark).columns
    with pytest.raises(NoNewData):
        h.read(spark, dates=["20240109"])


def test_full_replace_and_schema_evolution(spark, tmp_path):
    h = HistoryTable(str(tmp_path / "h"))
    h.replace_all(history_rows(spark, [("1", "a", D(2024, 1, 1))]))
    h.replace_window(spark.createDataFrame([("2", "n", D(2024, 1, 2))], "id string, w string, ingestion_date date"),
                     {"20240102"})
    got = sorted((r.id, r.v, r.w) for r in h.read(spark).collect())
    assert got == [("1", "a", None), ("2", None, "n")]
    h.replace_all(history_rows(spark, [("3", "c", D(2024, 1, 3))]))
    assert [r.id for r in h.read(spark).collect()] == ["3"]


def test_views(spark, tmp_path):
    assert view_location("silver", "master", "f") == ("master", "f")
    assert view_location("bronze", "history", "f") == ("bronze", "history/f")
    name = view_name("bronze", "history", "my-folder", "ds")
    assert name == "bronze__history__my_folder__ds"
    h = HistoryTable(str(tmp_path / "h"))
    h.replace_all(history_rows(spark, [("1", "a", D(2024, 1, 1))]))
    publish_view(spark, name, h.path)
    assert spark.table(name).count() == 1


def test_upsert_join_spreads_null_keys(spark):
    from quayside.operators.upsert import upsert
    t = history_rows(spark, [(None, "a", D(2024, 1, 1))] * 3 + [("1", "x", D(2024, 1, 1))])
    u = history_rows(spark, [(None, "b", D(2024, 1, 2)), ("1", "y", D(2024, 1, 2))])
    out = upsert(t, u)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "__s" in plan and "FullOuter" in plan
    assert sorted((r.id or "", r.v) for r in out.collect()) == [("", "a"), ("", "a"), ("", "a"), ("", "b"),
                                                               ("1", "y")]


def test_full_replace_drops_dates_not_rebuilt_and_survives_a_failed_job(spark, tmp_path):
    h = HistoryTable(str(tmp_path / "h"))
    h.replace_all(history_rows(spark, [(str(i), "old", D(2024, 1, i)) for i in range(1, 5)]))
    m = h.replace_all(history_rows(spark, [("3", "new", D(2024, 1, 3)), ("5", "new", D(2024, 1, 5))]))
    assert m["dates_dropped"] == ["2024-01-01", "2024-01-02", "2024-01-04"]
    assert sorted((r.id, r.v) for r in h.read(spark).collect()) == [("3", "new"), ("5", "new")]
    from pyspark.sql import functions as F
    boom = history_rows(spark, [("9", "x", D(2024, 1, 9))]).withColumn(
        "v", F.raise_error(F.lit("executor-side failure")).cast("string"))
    with pytest.raises(Exception):
        h.replace_all(boom)
    assert sorted((r.id, r.v) for r in h.read(spark).collect()) == [("3", "new"), ("5", "new")]


def test_full_replace_without_usable_rows_is_refused(spark, tmp_path):
    h = HistoryTable(str(tmp_path / "h"))
    h.replace_all(history_rows(spark, [("1", "a", D(2024, 1, 1))]))
    for rows in ([], [("2", "b", None)]):
        for rebalance in (False, True):
            with pytest.raises(NoNewData):
                h.replace_all(history_rows(spark, rows), rebalance=rebalance)
    assert [r.id for r in h.read(spark).collect()] == ["1"]


def test_an_empty_window_is_emptied_in_either_layout(spark, tmp_path):
    for rebalance in (False, True):
        h = HistoryTable(str(tmp_path / f"h{rebalance}"))
        h.replace_all(history_rows(spark, [(str(i), "a", D(2024, 1, i)) for i in (1, 2)]))
        m = h.replace_window(history_rows(spark, []), {"20240102"}, rebalance=rebalance)
        assert m["dates_emptied"] == ["2024-01-02"] and m["rows"] == 0
        assert [r.id for r in h.read(spark).collect()] == ["1"]


def test_history_refuses_a_changed_type_and_finds_columns_in_any_case(spark, tmp_path):
    from quayside.errors import ContractError
    h = HistoryTable(str(tmp_path / "h"))
    h.replace_all(history_rows(spark, [("1", "a", D(2024, 1, 1))]))
    with pytest.raises(ContractError, match="'v'"):
        h.replace_window(spark.createDataFrame([("2", 5, D(2024, 1, 2))], "id string, v int, ingestion_date date"),
                         {"20240102"})
    h.replace_window(spark.createDataFrame([("2", "b", D(2024, 1, 2))], "ID string, V string, ingestion_date date"),
                     {"20240102"})
    assert sorted((r.id, r.v) for r in h.read(spark).collect()) == [("1", "a"), ("2", "b")]


def test_history_read_runs_no_job_for_its_schema(spark, tmp_path):
    h = HistoryTable(str(tmp_path / "h"))
    h.replace_all(history_rows(spark, [(str(i), "a", D(2024, 1, i)) for i in range(1, 6)]))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("schema-read", "")
    h.read(spark)
    assert not tracker.getJobIdsForGroup("schema-read")
    spark.sparkContext.setJobGroup("other", "")


def test_insert_evolving_finds_columns_in_any_case(spark, tmp_path):
    from quayside.sinks.evolve import insert_evolving
    name = "evolve_case_" + tmp_path.name.replace("-", "_")
    spark.createDataFrame([], "id int, Value string").write.option("path", str(tmp_path / "t")).saveAsTable(name)
    assert insert_evolving(spark, name, spark.createDataFrame([(1, "x")], "id int, value string")) == []
    assert [tuple(r) for r in spark.table(name).collect()] == [(1, "x")]
    spark.sql(f"DROP TABLE {name}")


SCHEMA = "id long, ingestion_date date, v string"


def test_the_pointer_is_replaced_in_one_rename(spark, tmp_path):
    from quayside.sources import fs
    path = f"{tmp_path}/p/_CURRENT"
    for text in ("one", "two", "three"):
        fs.write_text(spark, path, text)
        assert fs.read_text(spark, path) == text
    assert [f for f in os.listdir(tmp_path / "p") if not f.startswith(".")] == ["_CURRENT"]


def test_versions_tell_which_dates_were_written(spark, tmp_path):
    h = HistoryTable(str(tmp_path / "h"))
    assert h.versions(spark) == {}
    h.replace_all(history_rows(spark, [("1", "a", D(2024, 1, 1)), ("2", "b", D(2024, 1, 2))]))
    before = h.versions(spark)
    assert sorted(before) == ["20240101", "20240102"] and h.versions(spark) == before
    h.replace_window(history_rows(spark, [("3", "c", D(2024, 1, 3))]), {"20240102", "20240103"})
    after = h.versions(spark)
    assert sorted(after) == ["20240101", "20240103"] and after["20240101"] == before["20240101"]  # 2 Jan was emptied
    h.replace_window(history_rows(spark, [("3", "c", D(2024, 1, 3))]), {"20240103"})  # the same rows, written again
    assert h.versions(spark)["20240103"] != after["20240103"]
    assert not [f for f in os.listdir(h.path) if f.startswith("_changes")]


def test_persistent_views_of_two_databases_leave_each_other_alone(spark, tmp_path):
    h = HistoryTable(str(tmp_path / "h"))
    h.replace_all(history_rows(spark, [("1", "a", D(2024, 1, 1))]))
    h.replace_window(spark.createDataFrame([("2", "n", D(2024, 1, 2))], "id string, w string, ingestion_date date"), {"20240102"})
    spark.sql(f"CREATE DATABASE other LOCATION '{tmp_path}/db'")

    def behind(db):
        return [r.tableName for r in spark.sql(f"SHOW TABLES IN {db}").collect() if r.tableName.startswith("kept_history__files_")]

    publish = lambda name: publish_view(spark, name, h.path, persistent=True, schema=h.schema(spark),
                                        partitions=["ingestion_date"])
    for name in ("kept_history", "other.kept_history", "kept_history", "other.kept_history", "default.kept_history"):
        publish(name)
        for v in ("kept_history", "other.kept_history") if name != "kept_history" else ("kept_history",):
            assert sorted((r.id, r.v, r.w) for r in spark.table(v).collect()) == [("1", "a", None), ("2", None, "n")]
    assert len(behind("default")) == len(behind("other")) == 1
    spark.sql("DROP VIEW kept_history")
    spark.sql(f"DROP TABLE {behind('default')[0]}")
    spark.sql("DROP DATABASE other CASCADE")


def test_a_full_replace_lists_the_table_in_a_few_calls(spark, tmp_path, monkeypatch):
    from quayside.sources import fs
    h = HistoryTable(str(tmp_path / "h"))
    rows = spark.range(40).selectExpr("string(id) AS id", "'a' AS v", "date_add(DATE'2024-01-01', int(id)) AS ingestion_date")
    h.replace_all(rows)
    calls = []
    listing = fs.list_dir
    monkeypatch.setattr(fs, "list_dir", lambda *a: calls.append(a) or listing(*a))
    m = h.replace_all(rows.where("id < 30"))
    assert len(m["dates_written"]) == 30 and len(m["dates_dropped"]) == 10 and len(calls) <= 4
