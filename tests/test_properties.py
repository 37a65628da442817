
import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from quayside.operators.latest import latest_per_key
from quayside.operators.upsert import upsert
from quayside.sinks.history import replace_window_frame

SCHEMA = "id long, ingestion_date date, v string"
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def rows(raw, day_offset=0):
    return [(k, dt.date(2024, 1, d + day_offset), v) for k, d, v in raw]


def state(df):
    return sorted((r.id, r.ingestion_date, r.v) for r in df.collect())


batch = st.lists(st.tuples(st.integers(0, 6), st.integers(1, 5), st.sampled_from("abc")), max_size=10)


@SETTINGS
@given(a=batch, b=batch)
def test_replay_order_does_not_matter_when_dates_differ(spark, a, b):
    # batch b is strictly later than batch a (days 11..15 vs 1..5)
    empty = spark.createDataFrame([], SCHEMA)
    fa = spark.createDataFrame(rows(a), SCHEMA)
    fb = spark.createDataFrame(rows(b, 10), SCHEMA)
    a_then_b = upsert(upsert(empty, fa, tiebreak=["v"]), fb, tiebreak=["v"])
    b_then_a = upsert(upsert(empty, fb, tiebreak=["v"]), fa, tiebreak=["v"])
    at_once = upsert(empty, fa.unionByName(fb), tiebreak=["v"])
    assert state(a_then_b) == state(b_then_a) == state(at_once)


@SETTINGS
@given(history=batch, new=batch, window=st.sets(st.integers(1, 5), min_size=1, max_size=3))
def test_window_replace_touches_only_window_dates(spark, history, new, window):
    h = spark.createDataFrame(rows(history), SCHEMA)
    n = spark.createDataFrame(rows(new), SCHEMA)
    days = {f"202401{d:02d}" for d in window}
    out = state(replace_window_frame(h, n, days))
    inside = {dt.date(2024, 1, d) for d in window}
    assert [r for r in out if r[1] not in inside] == sorted(r for r in rows(history) if r[1] not in inside)
    assert [r for r in out if r[1] in inside] == sorted(r for r in rows(new) if r[1] in inside)


@SETTINGS
@given(data=batch)
def test_latest_is_one_row_per_key_and_a_maximum(spark, data):
    df = spark.createDataFrame(rows(data), SCHEMA)
    out = state(latest_per_key(df, ["id"]))
    assert len({r[0] for r in out}) == len(out) == len({k for k, _, _ in data})
    for k, d, _ in out:
        assert d == max(day for key, day, _ in rows(data) if key == k)
