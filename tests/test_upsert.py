"""Latest-per-key (W1) and the conditional upsert (K4) on the FIXTURES.md §D table."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from quayside.operators.latest import latest_per_key
from quayside.operators.upsert import upsert

SCHEMA = "id long, ingestion_date date, v string"
D = dt.date


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def state(df):
    return sorted(((r.id, r.ingestion_date, r.v) for r in df.collect()),
                  key=lambda t: tuple((x is not None, x or 0) if i == 0 else (x is not None, x or "") if i == 2
                                      else (x is not None, x or D(1, 1, 1)) for i, x in enumerate(t)))


@pytest.mark.parametrize("target,updates,expected", [
    ([(1, D(2024, 1, 2), "a")], [(1, D(2024, 1, 3), "b")], [(1, D(2024, 1, 3), "b")]),
    ([(1, D(2024, 1, 2), "a")], [(1, D(2024, 1, 2), "b")], [(1, D(2024, 1, 2), "b")]),
    ([(1, D(2024, 1, 2), "a")], [(1, D(2024, 1, 1), "b")], [(1, D(2024, 1, 2), "a")]),
    ([], [(2, D(2024, 1, 1), "b"), (2, D(2024, 1, 2), "c")], [(2, D(2024, 1, 2), "c")]),
    ([(3, D(2024, 1, 2), "a")], [], [(3, D(2024, 1, 2), "a")]),
    ([(3, None, "a")], [(3, D(2024, 1, 3), "b")], [(3, None, "a")]),
])
def test_upsert_rules(spark, target, updates, expected):
    assert state(upsert(frame(spark, target), frame(spark, updates))) == expected


def test_null_keys_never_match(spark):
    out = upsert(frame(spark, [(None, D(2024, 1, 1), "a")]),
                 frame(spark, [(None, D(2024, 1, 2), "b"), (None, D(2024, 1, 3), "c")]))
    assert sorted(r.v for r in out.collect()) == ["a", "c"]
    dropped = upsert(frame(spark, [(None, D(2024, 1, 1), "a"), (1, D(2024, 1, 1), "x")]),
                     frame(spark, [(None, D(2024, 1, 2), "b")]), on_null_key="drop")
    assert state(dropped) == [(1, D(2024, 1, 1), "x")]
    with pytest.raises(Exception):
        upsert(frame(spark, []), frame(spark, [(None, D(2024, 1, 2), "b")]), on_null_key="fail").collect()
    kept = upsert(frame(spark, [(None, D(2024, 1, 1), "a")]), frame(spark, [(1, D(2024, 1, 2), "b")]),
                  on_null_key="fail")
    assert state(kept) == [(None, D(2024, 1, 1), "a"), (1, D(2024, 1, 2), "b")]


def test_new_update_columns_evolve_the_target(spark):
    target = frame(spark, [(1, D(2024, 1, 1), "a"), (2, D(2024, 1, 1), "b")])
    updates = spark.createDataFrame([(1, D(2024, 1, 2), "c", 9)], "id long, ingestion_date date, v string, w int")
    out = sorted(tuple(r) for r in upsert(target, updates).collect())
    assert out == [(1, D(2024, 1, 2), "c", 9), (2, D(2024, 1, 1), "b", None)]


def test_latest_per_key_ties_and_nulls(spark):
    df = frame(spark, [(1, D(2024, 1, 1), "a"), (1, None, "n"), (1, D(2024, 1, 3), "b"), (1, D(2024, 1, 3), "c"),
                       (None, D(2024, 1, 1), "x"), (None, D(2024, 1, 2), "y")])
    out = latest_per_key(df, ["id"], ["ingestion_date"], tiebreak=["v"])
    assert sorted(((r.id or 0), r.v) for r in out.collect()) == [(0, "y"), (1, "c")]
    hashed = {r.v for r in latest_per_key(df, ["id"]).where("id = 1").collect()}
    assert hashed <= {"b", "c"} and len(hashed) == 1


def test_latest_per_key_plans_a_partial_group_limit(spark):
    df = frame(spark, [(1, D(2024, 1, 1), "a")])
    plan = latest_per_key(df, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


rows_strategy = st.lists(st.tuples(st.integers(0, 5), st.integers(1, 4), st.sampled_from("abc")), max_size=12)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(target=rows_strategy, updates=rows_strategy)
def test_upsert_matches_brute_force_and_is_idempotent(spark, target, updates):
    def rows(raw):
        return [(k, D(2024, 1, d), v) for k, d, v in raw]
    t = latest_per_key(frame(spark, rows(target)), ["id"], tiebreak=["v"])
    u = frame(spark, rows(updates))
    once = upsert(t, u, tiebreak=["v"])
    # brute force on the driver over the tiny fixture
    cur = {r.id: (r.ingestion_date, r.v) for r in t.collect()}
    newest = {}
    for k, d, v in rows(updates):
        if k not in newest or (d, v) > newest[k]:
            newest[k] = (d, v)
    for k, (d, v) in newest.items():
        if k not in cur or d >= cur[k][0]:
            cur[k] = (d, v)
    assert state(once) == sorted((k, d, v) for k, (d, v) in cur.items())
    assert state(upsert(once, u, tiebreak=["v"])) == state(once)
    assert once.groupBy("id").count().where("count > 1").count() == 0


def test_row_hash_tiebreak_ignores_the_run_stamp(spark):
    from pyspark.sql import functions as F
    base = frame(spark, [(1, D(2024, 1, 3), v) for v in "abcdefgh"])
    winners = {latest_per_key(base.withColumn("processing_time", F.lit(ts).cast("timestamp")), ["id"]).first().v
               for ts in ("2024-01-01 00:00:00", "2025-06-30 12:34:56", "2026-12-02 08:00:00")}
    assert len(winners) == 1


def test_a_changed_type_is_refused_and_a_wider_number_is_kept(spark):
    from quayside.errors import ContractError
    target = spark.createDataFrame([(1, D(2024, 1, 1), 2)], "id long, ingestion_date date, n int")
    for odd in ("decimal(6,2)", "bigint", "string"):
        updates = spark.createDataFrame([(1, D(2024, 1, 2), 5)], "id long, ingestion_date date, n int")
        with pytest.raises(ContractError, match="'n'"):
            upsert(target, updates.withColumn("n", updates.n.cast(odd)))
    wide = spark.createDataFrame([(1, D(2024, 1, 1), 2)], "id long, ingestion_date date, n bigint")
    narrow = spark.createDataFrame([(2, D(2024, 1, 2), 5)], "id int, ingestion_date date, N int")
    assert sorted((r.id, r.n) for r in upsert(wide, narrow).collect()) == [(1, 2), (2, 5)]  # N is n


def test_ties_between_rows_with_maps_inside_structs(spark):
    df = spark.sql("SELECT 1 AS id, DATE'2024-01-01' AS ingestion_date, named_struct('m', map('a', x)) AS s, x AS v "
                   "FROM VALUES (1), (2) AS t(x)")
    assert latest_per_key(df, ["id"]).count() == 1
    assert upsert(df.where("v = 1"), df.where("v = 2")).count() == 1
