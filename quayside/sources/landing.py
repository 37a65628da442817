"""Landing feed layout ``<root>/<dataset>/<yyyyMMdd>/*.json`` and folder discovery.

Discovery is a driver-side listing of folder metadata (one entry per delivery
day), never of file contents. The chosen folders are then read by one
distributed JSON scan (:mod:`quayside.sources.json_feed`).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from quayside.functions.dates import apply_lower_bound, lookback_window
from quayside.sources import fs


@dataclass(frozen=True)
class LandingFeed:
    root: str
    dataset: str

    @property
    def path(self) -> str:
        return f"{self.root.rstrip('/')}/{self.dataset}"

    def folder(self, date: str) -> str:
        return f"{self.path}/{date}"

    # -- S2 / S3 / S4 / S5 / F4 ------------------------------------------------
    def date_folders(self, spark: SparkSession, dates: str = "all",
                     starting_from: str | None = None, days_back: int = 1) -> list[str]:
        """Folders to read for a request (sorted).

        ``dates="all"``: every folder of the dataset whose name is ``>=
        starting_from``, from one listing of the dataset folder; empty ones
        are left in, since Spark's (parallel) file listing simply finds no
        file there. Otherwise ``dates`` is a comma list widened by the
        look-back window, and only existing, non-empty folders are kept (a
        couple of metadata calls per requested day), so a missing day never
        fails the scan.
        """
        if dates is None or not str(dates).strip():
            raise ValueError("Empty input for ingestion dates")
        if str(dates).strip().lower() == "all":
            names = [e.name for e in fs.list_dir(spark, self.path) if e.is_dir]
            return [self.folder(n) for n in apply_lower_bound(names, starting_from)]
        window = lookback_window(dates, starting_from, days_back)
        return [p for p in (self.folder(d) for d in sorted(window)) if fs.is_nonempty(spark, p)]

    # -- S7 / S8 ---------------------------------------------------------------
    def files(self, spark: SparkSession) -> list[str]:
        """Paths of :meth:`file_table`, sorted; none when the dataset folder is missing."""
        if not fs.exists(spark, self.path):
            return []
        return [r["path"] for r in self.file_table(spark).select("path").sort("path").collect()]

    def file_table(self, spark: SparkSession) -> DataFrame:
        """path, length, modificationTime of every file below the dataset folder, recursively, by Spark's
        listing (the folder must exist): a table to filter and count, of which nothing needs to come to
        the driver."""
        return fs.file_table(spark, [self.path], recursive=True)

    def latest_file(self, spark: SparkSession) -> list[str]:
        """The lexicographically greatest file path below the dataset, as a 0- or 1-element list.

        Same answer as the maximum over the full recursive listing, found by
        descending from the top: every path below a folder starts with
        ``<folder>/``, so the children are ranked by that prefix (a file by its
        own path) and only the greatest one is explored, falling back to the
        next one when a folder holds no file. A few folder listings instead of
        listing every delivery file.
        """
        return _greatest_file(spark, self.path)


def window_dates_for(dates: str, starting_from: str | None = None, days_back: int = 1) -> set[str] | None:
    """Dates a windowed replace covers; ``None`` for a full (``all``) rebuild."""
    if str(dates).strip().lower() == "all":
        return None
    return lookback_window(dates, starting_from, days_back)


def _greatest_file(spark: SparkSession, path: str) -> list[str]:
    entries = fs.list_dir(spark, path)
    for e in sorted(entries, key=lambda e: e.path + "/" if e.is_dir else e.path, reverse=True):
        if not e.is_dir:
            return [e.path]
        found = _greatest_file(spark, e.path)
        if found:
            return found
    return []
