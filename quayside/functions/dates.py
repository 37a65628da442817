"""Delivery dates: parsing the requested list and the one-day look-back window.

Dates are ``yyyyMMdd`` text, as in landing folder names. These helpers run on
the driver over the handful of dates a run asks for; the DataFrame form of the
window is :func:`lookback_window_frame`.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDER_DATE_FORMAT = "%Y%m%d"  # Python form of the folder pattern
FOLDER_DATE_PATTERN = "yyyyMMdd"  # Spark datetime-pattern form of the same


def parse_date_list(text: str) -> list[str]:
    """Split a comma list of ``yyyyMMdd`` dates; trims blanks, rejects bad dates.

    An empty request is an error, as is any text that is not a calendar date.
    """
    if text is None or not text.strip():
        raise ValueError("Empty input for ingestion dates")
    dates = [piece.strip() for piece in text.split(",")]
    for d in dates:
        if len(d) != 8 or not d.isdigit():
            raise ValueError(f"not a yyyyMMdd date: {d!r}")
        dt.datetime.strptime(d, FOLDER_DATE_FORMAT)
    return dates


def apply_lower_bound(names: Iterable[str], starting_from: str | None) -> list[str]:
    """Keep names ``>= starting_from`` (text comparison); no bound keeps all."""
    return [n for n in names if starting_from is None or n >= starting_from]


def lookback_window(dates: str | Iterable[str], starting_from: str | None = None,
                    days_back: int = 1) -> set[str]:
    """Requested dates (after the lower bound) plus each one's previous day(s).

    The bound is applied before the subtraction, so the added day may fall
    before it. Set semantics: duplicates collapse.
    """
    requested = parse_date_list(dates) if isinstance(dates, str) else list(dates)
    kept = apply_lower_bound(requested, starting_from)
    window = set(kept)
    for d in kept:
        day = dt.datetime.strptime(d, FOLDER_DATE_FORMAT)
        for back in range(1, days_back + 1):
            window.add((day - dt.timedelta(days=back)).strftime(FOLDER_DATE_FORMAT))
    return window


def to_date_values(dates: Iterable[str]) -> list[dt.date]:
    """``yyyyMMdd`` text -> ``datetime.date`` literals (for partition predicates)."""
    return sorted(dt.datetime.strptime(d, FOLDER_DATE_FORMAT).date() for d in dates)


def in_dates(column: Column | str, dates: Iterable[str]) -> Column:
    """``column IN (date literals)``; on a partition column this prunes partitions."""
    c = F.col(column) if isinstance(column, str) else column
    return c.isin(to_date_values(dates))
