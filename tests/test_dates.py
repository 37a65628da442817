import pytest

from quayside.functions.dates import apply_lower_bound, lookback_window, parse_date_list


def test_window_adds_previous_days():
    assert lookback_window("20240110,20240115") == {"20240109", "20240110", "20240114", "20240115"}


def test_bound_applies_before_subtraction():
    # 10 Jan survives the bound, so 9 Jan is added even though it precedes it.
    assert lookback_window("20240108,20240110", starting_from="20240110") == {"20240109", "20240110"}


def test_set_semantics_and_month_edges():
    assert lookback_window("20240301,20240302") == {"20240229", "20240301", "20240302"}


def test_blanks_are_trimmed():
    assert parse_date_list(" 20240101 , 20240102") == ["20240101", "20240102"]


@pytest.mark.parametrize("bad", ["", "   ", "2024-01-01", "20241301", "2024010", "abcdefgh"])
def test_bad_dates_raise(bad):
    with pytest.raises(ValueError):
        lookback_window(bad)


def test_lower_bound_is_text_comparison():
    assert apply_lower_bound(["20231231", "20240101", "20240102"], "20240101") == ["20240101", "20240102"]
    assert apply_lower_bound(["a", "b"], None) == ["a", "b"]


def test_window_frame_matches_driver_form(spark):
    import datetime as dt
    df = spark.createDataFrame([(dt.date(2024, 1, 10),), (dt.date(2024, 1, 15),), (dt.date(2024, 1, 11),)], "d date")
    frame = df.union(df.selectExpr("date_sub(d, 1)")).distinct()
    got = {r.d.strftime("%Y%m%d") for r in frame.collect()}
    assert got == lookback_window("20240110,20240115,20240111")
