"""Run outcomes and the two error kinds a run can end with."""

from __future__ import annotations

import enum
from dataclasses import dataclass, field
from typing import Any


class Outcome(str, enum.Enum):
    SUCCESS = "SUCCESS"
    NO_NEW_DATA = "NO_NEW_DATA"
    ERROR = "ERROR"


class NoNewData(Exception):
    """Nothing to ingest: no folder, no envelope, or no rows."""


class ContractError(ValueError):
    """A dataset contract or a feed shape that cannot be honoured.

    Raised while columns are being built, before any Spark job runs.
    """


@dataclass
class RunResult:
    outcome: Outcome
    message: str = ""
    metrics: dict[str, Any] = field(default_factory=dict)

    @property
    def ok(self) -> bool:
        return self.outcome is Outcome.SUCCESS
