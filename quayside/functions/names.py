"""Column references that survive dots, back-ticks and case differences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from quayside.errors import ContractError


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    """``F.col`` for a top-level name taken literally (``a.b`` is one column)."""
    return F.col(quote(name))


def resolve(name: str, columns: Sequence[str], case_sensitive: bool = False) -> str | None:
    """The actual column matching ``name`` under the session's case rule.

    ``None`` when absent; :class:`ContractError` when several columns differ
    only by case and the match is therefore ambiguous.
    """
    if name in columns:
        return name
    if case_sensitive:
        return None
    hits = [c for c in columns if c.lower() == name.lower()]
    if len(hits) > 1:
        raise ContractError(f"column {name!r} is ambiguous: {hits}")
    return hits[0] if hits else None
