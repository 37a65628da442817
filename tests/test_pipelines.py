"""Run shapes end to end: landing -> history -> current state, with outcomes."""

import datetime as dt
import re

import pytest

from quayside.errors import NoNewData, Outcome
from quayside.plans.contract import Contract
from quayside.plans.current_state import build_current_state
from quayside.plans.history_ingest import ingest_history
from quayside.sinks.current import CurrentStateTable
from quayside.sinks.history import HistoryTable
from quayside.sources.landing import LandingFeed

CONTRACT = Contract.from_dict({
    "origin_conf": {"type": "struct", "fields": [{"name": "id", "type": "string"},
                                                 {"name": "v", "type": "string"}]},
    "fields": [{"name": "id", "source_name": "id", "type": "long"},
               {"name": "v", "source_name": "v", "type": "integer"}]})


def target_table(tmp_path, label, num_buckets=2):
    return CurrentStateTable(f"{re.sub(r'[^a-z0-9_]', '_', tmp_path.name)}_{label}", key="id", num_buckets=num_buckets,
                             location=str(tmp_path / label))


def test_daily_runs(spark, landing, tmp_path):
    root = landing({
        "20240101/a.json": {"Data": [{"id": 1, "v": 10}, {"id": 2, "v": 20}]},
        "20240102/a.json": {"Data": [{"id": 1, "v": 11}]},
    })
    feed = LandingFeed(root, "feed")
    history = HistoryTable(str(tmp_path / "history"))
    target = target_table(tmp_path, "current", num_buckets=4)

    assert ingest_history(spark, feed, history, "all").ok
    res = build_current_state(spark, history, CONTRACT, target, reload=True, view="cur_view",
                              freshness_column="ingestion_date")
    assert res.ok and res.metrics["rows_written"] == 2
    assert res.metrics["volume"] == 3 and res.metrics["freshness"] == dt.date(2024, 1, 2)
    assert sorted((r.id, r.v) for r in spark.table("cur_view").collect()) == [(1, 11), (2, 20)]

    # a late correction for 2 Jan arrives with a new day; only the window is replaced
    landing({"20240103/a.json": {"Data": [{"id": 2, "v": 21}, {"id": 3, "v": 30}]},
             "20240102/b.json": {"Data": [{"id": 1, "v": 12}]}})
    res = ingest_history(spark, feed, history, "20240103")
    assert res.ok and res.metrics["dates_written"] == ["2024-01-02", "2024-01-03"]
    assert history.read(spark).count() == 6

    res = build_current_state(spark, history, CONTRACT, target, dates=["20240102", "20240103"], view="cur_view",
                              freshness_column="date_int")
    assert res.ok and res.metrics["volume"] == 4 and "freshness" not in res.metrics
    got = sorted((r.id, r.v, r.ingestion_date) for r in spark.table("cur_view").collect())
    assert got[0][0] == 1 and got[0][1] in (11, 12) and got[0][2] == dt.date(2024, 1, 2)
    assert got[1:] == [(2, 21, dt.date(2024, 1, 3)), (3, 30, dt.date(2024, 1, 3))]


def test_no_new_data_outcomes(spark, landing, tmp_path):
    root = landing({"20240101/a.json": {"Data": []}})
    history = HistoryTable(str(tmp_path / "history"))
    assert ingest_history(spark, LandingFeed(root, "feed"), history, "20240101").outcome is Outcome.NO_NEW_DATA
    assert ingest_history(spark, LandingFeed(root, "nothing"), history, "all").outcome is Outcome.NO_NEW_DATA
    with pytest.raises(NoNewData):
        history.replace_all(spark.createDataFrame([], "id string, v string, ingestion_date date"))
    target = CurrentStateTable(str(tmp_path / "current"))
    assert build_current_state(spark, history, CONTRACT, target).outcome is Outcome.NO_NEW_DATA


def test_text_mode_and_single_file_layout(spark, landing, tmp_path):
    root = landing({"20240101/a.json": {"Data": [{"id": 1, "n": {"a": 1}}]}})
    history = HistoryTable(str(tmp_path / "history"))
    res = ingest_history(spark, LandingFeed(root, "feed"), history, "all", as_text=True, single_file=True)
    assert res.ok
    df = history.read(spark)
    assert df.schema["ingestion_date"].dataType.typeName() == "date"
    assert df.first()["n"] == '{"a":"1"}'


def test_struct_like_rule_keeps_scalar_arrays(spark, landing, tmp_path):
    root = landing({"20240101/a.json": {"Data": [{"id": 1, "tags": ["a", "b"], "s": {"x": 1}}]}})
    history = HistoryTable(str(tmp_path / "history"))
    assert ingest_history(spark, LandingFeed(root, "feed"), history, "all", nested="struct_like").ok
    r = history.read(spark).first()
    assert r["tags"] == ["a", "b"] and r["s"] == '{"x":"1"}'


def test_rebalance_groups_many_small_documents_by_date(spark, landing, tmp_path):
    import os

    from quayside.session import session_conf
    files = {f"2024010{1 + i % 2}/d{i:03d}.json": {"Data": [{"id": i, "v": "x"}]} for i in range(60)}
    root = landing(files)
    feed = LandingFeed(root, "feed")
    packed = {"spark.sql.files.maxPartitionBytes": "2048", "spark.sql.files.openCostInBytes": "1"}

    def files_per_date(path):
        return sorted(len([f for f in os.listdir(os.path.join(path, d)) if f.endswith(".parquet")])
                      for d in os.listdir(path) if d.startswith("ingestion_date="))

    out = {}
    for rebalance in (False, True):
        h = HistoryTable(str(tmp_path / f"h{rebalance}"))
        with session_conf(spark, packed):
            res = ingest_history(spark, feed, h, "all", rebalance=rebalance)
        assert res.ok and res.metrics["rows"] == 60
        out[rebalance] = (files_per_date(h.path), sorted(r.id for r in h.read(spark).collect()))
    assert out[False][1] == out[True][1] == sorted(str(i) for i in range(60))
    assert min(out[False][0]) > 1  # tasks mix documents of both dates: several files per date
    assert out[True][0] == [1, 1]  # one AQE-sized shuffle by date


def test_cast_losses_are_counted_on_the_run(spark, landing, tmp_path):
    root = landing({"20240101/a.json": {"Data": [{"id": 1, "v": "7"}, {"id": 2, "v": "x"}, {"id": 3}]}})
    history = HistoryTable(str(tmp_path / "h"))
    assert ingest_history(spark, LandingFeed(root, "feed"), history, "all").ok
    target = target_table(tmp_path, "cur")
    res = build_current_state(spark, history, CONTRACT, target, reload=True)
    assert res.ok and res.metrics["volume"] == 3
    assert res.metrics["cast_nulls_v"] == 1 and res.metrics["cast_nulls_id"] == 0
    assert sorted((r.id, r.v) for r in target.read(spark).collect()) == [(1, 7), (2, None), (3, None)]
    assert not [c for c in target.read(spark).columns if c.startswith("__lost_")]


def test_changed_only_runs_match_a_full_read(spark, landing, tmp_path):
    root = landing({f"2024010{d}/a.json": {"Data": [{"id": i, "v": str(d * 10 + i)} for i in range(1, 4)]}
                    for d in (1, 2, 3)})
    feed, history = LandingFeed(root, "feed"), HistoryTable(str(tmp_path / "h"))
    assert ingest_history(spark, feed, history, "all").ok
    incremental = target_table(tmp_path, "inc")
    first = build_current_state(spark, history, CONTRACT, incremental, changed_only=True)
    assert first.ok and first.metrics["history_dates"] == "all"  # no mark yet: full read
    assert build_current_state(spark, history, CONTRACT, incremental, changed_only=True).outcome \
        is Outcome.NO_NEW_DATA

    # a correction of day 3 (id 1 only) and a new day 4; the window also re-reads day 2
    landing({"20240103/b.json": {"Data": [{"id": 1, "v": "99"}]},
             "20240104/a.json": {"Data": [{"id": 4, "v": "4"}]}})
    assert ingest_history(spark, feed, history, "20240104,20240103").ok
    res = build_current_state(spark, history, CONTRACT, incremental, changed_only=True)
    assert res.ok and res.metrics["history_dates"] == ["20240102", "20240103", "20240104"]

    full = target_table(tmp_path, "full")
    assert build_current_state(spark, history, CONTRACT, full).ok

    def state(t):
        return sorted((r.id, r.v, r.ingestion_date) for r in t.read(spark).collect())
    assert state(incremental) == state(full)
    # id 1 has two rows on 3 Jan (a tie, decided by the row hash the same way in both runs)
    assert {r for r in state(full) if r[0] == 1} & {(1, 31, dt.date(2024, 1, 3)), (1, 99, dt.date(2024, 1, 3))}
    assert (4, 4, dt.date(2024, 1, 4)) in state(full)

    # a state built from explicit dates has absorbed nothing known: a full read, not a silent skip
    assert build_current_state(spark, history, CONTRACT, incremental, reload=True, dates=["20240101"]).ok
    assert build_current_state(spark, history, CONTRACT, incremental, changed_only=True).metrics["history_dates"] == "all"
    # an upsert from explicit dates leaves what was absorbed as it is
    assert build_current_state(spark, history, CONTRACT, incremental, dates=["20240101"]).ok
    assert build_current_state(spark, history, CONTRACT, incremental, changed_only=True).outcome is Outcome.NO_NEW_DATA
