"""History in the catalog: dates as partitions with locations of their own."""

import datetime as dt
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from quayside.errors import ContractError, NoNewData
from quayside.plans.cli import run
from quayside.session import session_conf
from quayside.sinks.history_catalog import CatalogHistoryTable

D = dt.date
SCHEMA = "id string, v string, ingestion_date date"


@pytest.fixture
def history(tmp_path):
    name = "hist_" + re.sub(r"\W", "_", tmp_path.name)
    return CatalogHistoryTable(name, str(tmp_path / "files"))


def rows(spark, *data):
    return spark.createDataFrame([(i, v, D(2024, 1, d) if d else None) for i, v, d in data], SCHEMA)


def held(spark, h):
    return sorted((r.id, r.v, r.ingestion_date.day) for r in h.read(spark).collect())


def runs(h):
    return sorted(x for x in os.listdir(h.location) if x.startswith("run-"))


def test_windows_replace_exactly_their_dates(spark, history):
    with pytest.raises(NoNewData):
        history.read(spark)
    m = history.replace_all(rows(spark, ("1", "a", 1), ("2", "a", 2), ("3", "a", 3), ("x", "a", None)))
    assert (m["rows"], m["rows_rejected"], m["dates_written"]) == (3, 1, ["2024-01-01", "2024-01-02", "2024-01-03"])
    for _ in range(2):  # a replay gives the same table
        m = history.replace_window(rows(spark, ("4", "b", 3), ("5", "b", 9), ("6", "b", 4)), {"20240102", "20240103", "20240104"})
        assert (m["rows"], m["rows_rejected"], m["dates_written"], m["dates_emptied"]) == (
            2, 1, ["2024-01-03", "2024-01-04"], ["2024-01-02"])
        assert held(spark, history) == [("1", "a", 1), ("4", "b", 3), ("6", "b", 4)]
    with pytest.raises(NoNewData):
        history.replace_window(rows(spark), {"20240103"}, refuse_empty=True)
    assert len(held(spark, history)) == 3
    assert [r.id for r in history.read(spark, {"20240103", "20240120"}).collect()] == ["4"]
    with pytest.raises(NoNewData):
        history.read(spark, {"20240120"})


def test_any_series_of_runs_against_the_rule(spark, history):
    r, want = random.Random(3), []
    for step in range(12):
        data = [(f"{step}-{i}", r.choice("abc"), r.randint(1, 5)) for i in range(r.randint(0, 5))]
        if r.random() < 0.25 and data or not want:
            data = data or [("0", "a", 1)]
            history.replace_all(rows(spark, *data))
            want = data
        else:
            days = {r.randint(1, 5) for _ in range(2)}
            history.replace_window(rows(spark, *data), {f"202401{d:02d}" for d in days}, rebalance=r.random() < 0.5)
            want = [x for x in want if x[2] not in days] + [x for x in data if x[2] in days]
        if want:
            assert held(spark, history) == sorted(want)
        referenced = {f.rsplit("/", 3)[-3] for f in spark.table(history.name).inputFiles()}
        assert referenced <= set(runs(history))


def test_a_reader_that_began_before_a_replace_finishes(spark, history):
    def begun():
        """An iterator that has its scan's files, of which it has read the first."""
        with session_conf(spark, {"spark.sql.files.maxPartitionBytes": "64"}):  # a file is several tasks
            it = history.read(spark).toLocalIterator()
            first = next(it)
        return it, [first]

    history.replace_all(rows(spark, ("1", "a", 1), ("2", "a", 2)))
    it, got = begun()
    history.replace_window(rows(spark, ("2", "b", 2)), {"20240101", "20240102"})
    assert sorted((r.id, r.v) for r in [*got, *it]) == [("1", "a"), ("2", "a")]
    assert held(spark, history) == [("2", "b", 2)]
    history.replace_all(rows(spark, ("3", "c", 3), ("3", "c", 4)))
    it, got = begun()
    history.replace_all(rows(spark, ("4", "d", 4)))
    assert [r.id for r in [*got, *it]] == ["3", "3"]
    history.replace_window(rows(spark, ("5", "e", 5)), {"20240105"})
    assert len(runs(history)) == 2 and len(held(spark, history)) == 2  # older runs are gone


def test_a_failed_run_leaves_the_table_and_no_folder(spark, history):
    history.replace_all(rows(spark, ("1", "a", 1), ("2", "a", 2)))
    bad = rows(spark, ("2", "b", 2)).withColumn("v", F.raise_error(F.lit("boom")).cast("string"))
    for action in (lambda: history.replace_window(bad, {"20240102"}), lambda: history.replace_all(bad)):
        with pytest.raises(Exception, match="boom"):
            action()
        assert held(spark, history) == [("1", "a", 1), ("2", "a", 2)] and len(runs(history)) == 1
    with pytest.raises(NoNewData):
        history.replace_all(rows(spark, ("x", "a", None)))
    assert len(held(spark, history)) == 2 and len(runs(history)) == 1


def test_columns_evolve_views_follow_and_types_are_kept(spark, history):
    history.replace_all(rows(spark, ("1", "a", 1)))
    spark.sql(f"CREATE OR REPLACE VIEW {history.name}_shown AS SELECT * FROM {history.name}")
    wider = spark.createDataFrame([("2", "n", D(2024, 1, 2))], "ID string, `w x` string, ingestion_date date")
    history.replace_window(wider, {"20240102"})
    assert sorted((r.id, r.v, r["w x"]) for r in history.read(spark).collect()) == [("1", "a", None), ("2", None, "n")]
    assert spark.table(f"{history.name}_shown").count() == 2  # the view was not refreshed
    with pytest.raises(ContractError):
        history.replace_window(spark.createDataFrame([("3", 5, D(2024, 1, 3))], "id string, v int, ingestion_date date"), {"20240103"})
    assert history.read(spark).count() == 2 and len(runs(history)) == 2
    spark.sql(f"DROP VIEW {history.name}_shown")


def test_versions_change_with_their_dates_only(spark, history):
    assert history.versions(spark) == {}
    history.replace_all(rows(spark, ("1", "a", 1), ("2", "a", 2)))
    before = history.versions(spark)
    assert history.versions(spark) == before and sorted(before) == ["20240101", "20240102"]
    history.replace_window(rows(spark, ("2", "a", 2)), {"20240102"})
    after = history.versions(spark)
    assert after["20240101"] == before["20240101"] and after["20240102"] != before["20240102"]


def test_reads_of_dates_are_pruned_by_the_catalog(spark, history):
    history.replace_all(rows(spark, *[(str(d), "a", d) for d in range(1, 21)]))
    df = history.read(spark, {"20240105", "20240106"})
    assert len(df.collect()) == 2
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*ingestion_date", plan) and "_metadata" not in plan
    assert len(df.inputFiles()) <= 20


def test_command_line_runs_into_the_catalog(spark, landing, tmp_path):
    root = landing({"20240101/a.json": {"Data": [{"id": 1, "v": "a"}, {"id": 2, "v": "b"}]},
                    "20240102/a.json": {"Data": [{"id": 1, "v": "c"}]}})
    name = "hist_" + re.sub(r"\W", "_", tmp_path.name)
    base = ["history", "--landing-root", root, "--dataset", "feed", "--history", str(tmp_path / "h"), "--history-table", name]
    res = run([*base, "--dates", "all", "--view", f"{name}_shown", "--freshness-column", "ingestion_date",
               "--distribution-column", "v"], spark)
    assert res.ok and res.metrics["volume"] == 3 and res.metrics["freshness"] == D(2024, 1, 2)
    assert sorted((d["v"], d["count"]) for d in res.metrics["distribution"]) == [("a", 1), ("b", 1), ("c", 1)]
    landing({"20240102/b.json": {"Data": [{"id": 3, "v": "d"}]}})
    assert run([*base, "--dates", "20240102"], spark).ok
    assert spark.table(f"{name}_shown").count() == 4  # the view follows
    spark.sql(f"DROP VIEW {name}_shown")
