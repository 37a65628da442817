"""Dataset profile (A1/A2): volume, freshness, nulls/min/max and value distribution.

All of it is hash aggregation with map-side partial aggregates, so a hot
group costs one partial row per map task. The same metrics can ride on a
write through :func:`observed` instead of a second scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from quayside.functions.names import col


def profile_metrics(freshness_column: str | None = None, columns: Sequence[str] = ()) -> list[Column]:
    metrics = [F.count(F.lit(1)).alias("volume")]
    if freshness_column:
        metrics.append(F.max(col(freshness_column)).alias("freshness"))
    for c in columns:
        metrics += [F.count_if(col(c).isNull()).alias(f"null_{c}"),
                    F.min(col(c)).alias(f"min_{c}"),
                    F.max(col(c)).alias(f"max_{c}")]
    return metrics


def profile(df: DataFrame, by: Sequence[Column | str] = (), freshness_column: str | None = None,
            columns: Sequence[str] = ()) -> DataFrame:
    """One row per group (or one row overall) with the profile metrics."""
    metrics = profile_metrics(freshness_column, columns)
    return df.groupBy(*by).agg(*metrics) if by else df.agg(*metrics)


def distribution(df: DataFrame, column: str, by: Sequence[Column | str] = ()) -> DataFrame:
    """Row count per value of ``column`` (within optional groups)."""
    return df.groupBy(*by, col(column).alias(column)).agg(F.count(F.lit(1)).alias("count"))


def observed(df: DataFrame, name: str, freshness_column: str | None = None,
             columns: Sequence[str] = (), extra: Sequence[Column] = ()) -> tuple[DataFrame, Observation]:
    """Attach profile metrics (plus ``extra`` aggregates) to ``df``; read them from the
    Observation after its action."""
    obs = Observation(name)
    return df.observe(obs, *profile_metrics(freshness_column, columns), *extra), obs


def metrics_of(observation: Observation, **if_empty) -> dict:
    """The observed metrics. Adaptive execution drops the observing node with a plan that it finds
    empty, and then there are none: ``if_empty`` says what they are for no rows. Decisions about data
    are not taken from this, only reports."""
    try:
        return observation.get
    except (AssertionError, Py4JJavaError) as exc:
        if "AssertionError" not in f"{type(exc).__name__} {exc}":
            raise
        return dict(if_empty)
