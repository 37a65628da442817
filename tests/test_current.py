"""Current state as a view over bucketed catalog tables (K4 K5 K6)."""

import datetime as dt
import os
import re
from dataclasses import replace

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quayside.errors import ContractError, NoNewData
from quayside.session import session_conf
from quayside.sinks.current import CurrentStateTable
from quayside.sinks.views import publish_current

D = dt.date
SCHEMA = "id long, ingestion_date date, v string"


@pytest.fixture
def state(tmp_path):
    name = "state_" + re.sub(r"\W", "_", tmp_path.name)

    def make(suffix="", **options):
        options = {"num_buckets": 4, "tiebreak": ["v"], **options}
        return CurrentStateTable(name + suffix, location=str(tmp_path / "files"), **options)

    return make


def rows_of(spark, t):
    return sorted(((r.id is None, r.id or 0, r.ingestion_date, r.v) for r in t.read(spark).collect()))


def merged(base, updates):
    """Upsert rules by hand; updates have one row a key."""
    want = {k: (d, v) for k, d, v in base if k is not None}
    for k, d, v in updates:
        if k is not None and (k not in want or d >= want[k][0]):
            want[k] = (d, v)
    nulls = [(True, 0, d, v) for k, d, v in [*base, *updates] if k is None]
    return sorted([(False, k, d, v) for k, (d, v) in want.items()] + nulls)


def test_upserts_against_brute_force_and_replay(spark, state):
    base = [(i, D(2024, 1, 1 + i % 3), "a") for i in range(300)] + [(None, D(2024, 1, 1), "n")]
    upd = [(i, D(2024, 1, 2), "b") for i in range(0, 400, 7)]
    t = state(num_buckets=8)
    m = t.upsert(spark, spark.createDataFrame(base, SCHEMA))
    assert m["created"] and m["rows_written"] == 301 and m["num_buckets"] == 8
    m = t.upsert(spark, spark.createDataFrame(upd, SCHEMA))
    assert not m["created"] and m["rows_updates"] == len(upd)
    assert rows_of(spark, t) == merged(base, upd)
    t.upsert(spark, spark.createDataFrame(upd, SCHEMA))
    assert rows_of(spark, t) == merged(base, upd)
    more = [(None, D(2024, 1, 4), "m"), (5, D(2023, 1, 1), "old")]
    t.upsert(spark, spark.createDataFrame(more, SCHEMA))
    assert rows_of(spark, t) == merged([(k or None if n else k, d, v) for n, k, d, v in merged(base, upd)], more)


KEYS = st.one_of(st.none(), st.integers(0, 9))
ROWS = st.lists(st.tuples(KEYS, st.integers(1, 5).map(lambda d: D(2024, 1, d)), st.sampled_from("abc")), max_size=12)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(ROWS, min_size=1, max_size=3))
def test_any_series_of_updates_against_the_rule(spark, state, series):
    t, want = state(f"_{abs(hash(str(series)))}"), []
    for rows in series:
        newest = {}
        for k, d, v in rows:
            newest[k] = max(newest.get(k, (d, v)), (d, v))
        if not rows:
            with pytest.raises(NoNewData):
                t.upsert(spark, spark.createDataFrame(rows, SCHEMA))
            continue
        t.upsert(spark, spark.createDataFrame(rows, SCHEMA))
        want = [(None if n else k, d, v) for n, k, d, v in merged(want, [(k, d, v) for k, (d, v) in newest.items()])]
    if want:
        assert rows_of(spark, t) == merged(want, [])


def test_the_target_side_of_a_merge_is_not_shuffled(spark, state):
    t = state(num_buckets=16)
    t.upsert(spark, spark.createDataFrame([(i, D(2024, 1, 1), "a") for i in range(100)], SCHEMA))
    updates = spark.createDataFrame([(5, D(2024, 1, 2), "b"), (500, D(2024, 1, 2), "c")], SCHEMA)
    with session_conf(spark, t.settings(16)):
        frame = t.merge_frame(spark, t.deduped(updates))
        plan = frame._jdf.queryExecution().executedPlan().toString()
        got = sorted(r.id for r in frame.where("v <> 'a'").collect())
    assert got == [5, 500]
    # one exchange in all: the updates', which also deduplicates them
    assert re.findall(r"Exchange hashpartitioning\((\w+)#\d+L?, 16\)", plan) == ["id"] and plan.count("Exchange") == 1
    assert re.search(r"FileScan parquet .*Bucketed: true", plan) and "SortMergeJoin" in plan and "FullOuter" in plan
    # a build has one file for each bucket that holds rows
    t.upsert(spark, updates)
    files = [f for f in t.read(spark).inputFiles()]
    assert 1 < len(files) <= 16 and len({re.search(r"_(\d{5})\.c", f).group(1) for f in files}) == len(files)


def test_a_failed_build_leaves_the_view_and_no_table(spark, state):
    t = state()
    t.upsert(spark, spark.createDataFrame([(i, D(2024, 1, 1), "a") for i in range(50)], SCHEMA))
    before, live = rows_of(spark, t), t.live(spark)
    bad = spark.createDataFrame([(i, D(2024, 1, 2), "b") for i in range(40, 60)], SCHEMA).withColumn(
        "v", F.when(F.col("id") == 55, F.raise_error(F.lit("boom"))).otherwise(F.col("v")))
    for action in (t.upsert, t.reload):
        with pytest.raises(Exception, match="boom"):
            action(spark, bad)
        assert rows_of(spark, t) == before and t.live(spark) == live and list(t.builds(spark)) == [live.number]
        assert len(os.listdir(t.location)) == 1
    # a run that was killed leaves a build that no view shows: the next one gets a number of its own
    spark.table(live.table).write.option("path", f"{t.location}/left").saveAsTable(live.table.replace("000001", "000002"))
    assert t.live(spark) == live
    assert t.upsert(spark, bad.where("id < 50"))["build"] == 3 and t.read(spark).count() == 50


def test_a_reload_swaps_the_view_and_older_readers_finish(spark, state):
    t = state()
    t.upsert(spark, spark.createDataFrame([(4, D(2024, 1, 2), "a")], SCHEMA))
    opened = t.read(spark)
    m = t.reload(spark, spark.createDataFrame([(5, D(2024, 1, 1), "b")], SCHEMA))
    assert m["build"] == 2 and [(r.id, r.v) for r in t.read(spark).collect()] == [(5, "b")]
    assert [(r.id, r.v) for r in opened.collect()] == [(4, "a")]  # the build it opened is still there
    for action in (t.reload, t.upsert):
        with pytest.raises(NoNewData):
            action(spark, spark.createDataFrame([], SCHEMA))
    assert t.live(spark).number == 2
    t.reload(spark, spark.createDataFrame([(6, D(2024, 1, 1), "c")], SCHEMA))
    assert sorted(t.builds(spark)) == [2, 3] and len(os.listdir(t.location)) == 2  # keep=1: one before the live one
    replace(t, keep=0).upsert(spark, spark.createDataFrame([(6, D(2024, 1, 2), "d")], SCHEMA))
    assert list(t.builds(spark)) == [4]


def test_keys_and_bucket_counts(spark, state):
    rows = spark.createDataFrame([(i, D(2024, 1, 1), str(i % 7)) for i in range(40)], SCHEMA)
    newer = spark.createDataFrame([(i, D(2024, 1, 2), "b") for i in range(0, 40, 3)], SCHEMA)
    t = state(num_buckets=4)
    t.upsert(spark, rows)
    with pytest.raises(ContractError, match="key"):
        replace(t, key="v").upsert(spark, newer)
    m = replace(t, num_buckets=10).upsert(spark, newer)  # a new build may have other buckets
    assert m["num_buckets"] == 10 and t.live(spark).buckets == 10
    assert replace(t, num_buckets=0).upsert(spark, newer)["num_buckets"] == 10  # as the live build
    assert t.read(spark).count() == 40 and t.read(spark).where("v = 'b'").count() == 14
    by_v = replace(t, key="v", tiebreak=["id"])
    by_v.reload(spark, rows)  # a reload may change the key
    assert sorted((r.id, r.v) for r in by_v.read(spark).collect()) == sorted((max(i for i in range(40) if i % 7 == k), str(k)) for k in range(7))
    assert replace(t, num_buckets=0).reload(spark, rows)["num_buckets"] >= 64


def test_null_key_rules(spark, state):
    rows = spark.createDataFrame([(None, D(2024, 1, 1), "n"), (1, D(2024, 1, 1), "a")], SCHEMA)
    for rule, left in (("keep", 2), ("drop", 1)):
        t = state(f"_{rule}", on_null_key=rule)
        t.upsert(spark, rows)
        assert t.read(spark).count() == left
        t.upsert(spark, rows)
        assert t.read(spark).count() == (3 if rule == "keep" else 1)  # null keys match nothing
    with pytest.raises(Exception, match="null id"):
        state("_fail", on_null_key="fail").upsert(spark, rows)
    with pytest.raises(ValueError):
        state("_odd", on_null_key="odd").upsert(spark, rows)


def test_columns_evolve_and_a_changed_type_is_refused(spark, state):
    t = state(num_buckets=8)
    t.upsert(spark, spark.createDataFrame([(i, D(2024, 1, 1), "a") for i in range(50)], SCHEMA))
    t.upsert(spark, spark.createDataFrame([(3, D(2024, 1, 2), "b", 7)], SCHEMA + ", `w x` int"))
    got = {r.id: (r.v, r["w x"]) for r in t.read(spark).collect()}
    assert len(got) == 50 and got[3] == ("b", 7) and got[4] == ("a", None)
    t.upsert(spark, spark.createDataFrame([(4, D(2024, 1, 3), "c")], SCHEMA))
    assert spark.table(t.name).columns == ["id", "ingestion_date", "v", "w x"]
    with pytest.raises(ContractError):
        t.upsert(spark, spark.createDataFrame([(4, D(2024, 1, 3), 5)], "id long, ingestion_date date, v int"))


def test_views_over_the_state(spark, state):
    t = state()
    t.upsert(spark, spark.createDataFrame([(i, D(2024, 1, 1), "a") for i in range(20)], SCHEMA))
    publish_current(spark, "older_state", t)
    publish_current(spark, "kept_state", t, persistent=True)
    t.upsert(spark, spark.createDataFrame([(3, D(2024, 1, 2), "b")], SCHEMA))
    assert spark.table("older_state").where("v = 'b'").count() == 0  # the build it was made on
    assert spark.table("kept_state").where("v = 'b'").count() == 1  # follows the state
    spark.sql("CREATE OR REPLACE VIEW foreign_view AS SELECT 1 AS id")
    with pytest.raises(ContractError, match="another kind"):
        CurrentStateTable("foreign_view").upsert(spark, spark.createDataFrame([(1, D(2024, 1, 2), "b")], SCHEMA))
    for v in ("kept_state", "foreign_view"):
        spark.sql(f"DROP VIEW {v}")


def test_states_of_equal_names_in_two_databases(spark, state, tmp_path):
    t = state()
    spark.sql(f"CREATE DATABASE second LOCATION '{tmp_path}/second'")
    u = replace(t, name=f"second.{t.name}", location=None)
    for k, x in enumerate((t, u, t, u, u)):
        x.upsert(spark, spark.createDataFrame([(k, D(2024, 1, 1), x.name)], SCHEMA))
    assert {r.v for r in t.read(spark).collect()} == {t.name} and t.read(spark).count() == 2
    assert {r.v for r in u.read(spark).collect()} == {u.name} and u.read(spark).count() == 3
    spark.sql("DROP DATABASE second CASCADE")


def test_absorbed_dates_belong_to_a_build(spark, state):
    t = state()
    row = spark.createDataFrame([(1, D(2024, 1, 1), "a")], SCHEMA)
    assert t.absorbed(spark) is None
    t.upsert(spark, row, {"20240101": "1:5"})
    assert t.absorbed(spark) == {"20240101": "1:5"}
    t.upsert(spark, row, {"20240101": "1:5", "20240102": "2:-7"})
    assert len(t.absorbed(spark)) == 2
    t.reload(spark, row)  # from rows whose dates are not told
    assert t.absorbed(spark) is None
