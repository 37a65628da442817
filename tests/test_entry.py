"""The driver contract in __spark_entry__.py."""

import __spark_entry__ as entry
from quayside.plans.scenarios import SCENARIOS


def test_every_query_has_oracle_sql_or_is_declared_rows_only():
    queries, sqls = entry.queries(), entry.oracle_sql()
    assert set(sqls) <= set(queries)
    assert set(SCENARIOS) - set(sqls) == {"latest_file"}


def test_entry_runs_on_smoke_data(spark):
    df = entry.entry(spark)
    assert df.columns == ["id", "user_id", "event_type", "ts", "value", "props", "ingestion_date"]
    assert df.count() > 0
