"""Envelope flatten (P1): one row per array element, element fields promoted to columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.errors import ContractError, NoNewData
from quayside.functions.names import col, quote
from quayside.operators.lineage import LINEAGE_COLUMNS
from quayside.sources.json_feed import envelope_records_type

_RECORD = "__record"


def flatten_envelope(df: DataFrame, field: str = "Data", carry: Sequence[str] = ()) -> DataFrame:
    """Explode ``field`` and promote the record fields; sibling fields are dropped.

    ``carry`` columns (e.g. ``source_path``) are kept beside every record. Null
    or empty arrays yield no rows. A record field that collides with a carried
    or a lineage column, in any case, is a contract error (it would make later references ambiguous).

    When inference saw only empty arrays the element type is not a struct;
    that is reported as :class:`NoNewData` if no element exists at all, and as
    a contract error otherwise (records that are not objects).
    """
    record_type = envelope_records_type(df, field)
    if record_type is None:
        if df.where(F.size(col(field)) > 0).isEmpty():
            raise NoNewData(f"every '{field}' array is empty")
        raise ContractError(f"'{field}' elements are not objects")
    taken = {c.lower() for c in (*carry, *LINEAGE_COLUMNS)}
    clash = sorted(n for n in record_type.fieldNames() if n.lower() in taken)
    if clash:
        raise ContractError(f"record fields collide with lineage columns: {clash}")
    exploded = df.select(*[col(c) for c in carry], F.explode(col(field)).alias(_RECORD))
    return exploded.select(*[col(c) for c in carry],
                           *[F.col(f"{_RECORD}.{quote(n)}").alias(n) for n in record_type.fieldNames()])

