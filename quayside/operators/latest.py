"""Latest row per key.

``row_number() OVER (PARTITION BY key ORDER BY ingestion_date DESC, ...) = 1``.
Spark plans this with a partial ``WindowGroupLimit`` before the shuffle, so
each map task forwards at most one row per key: a key holding a third of all
rows is reduced map-side and cannot swamp one reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from quayside.functions.names import col
from quayside.operators.lineage import PROCESSING_TIME

ROW_HASH = "row_hash"


def _holds_map(dtype: DataType) -> bool:
    if isinstance(dtype, StructType):
        return any(_holds_map(f.dataType) for f in dtype.fields)
    return isinstance(dtype, MapType) or isinstance(dtype, ArrayType) and _holds_map(dtype.elementType)


def row_hash(df: DataFrame) -> Column:
    """A hash of the row; values that hold a map at any depth are left out (maps have no order). The
    run stamp is left out, too: it differs between runs over the same rows, and the winner of a tie
    must not."""
    hashable = [col(f.name) for f in df.schema.fields if not _holds_map(f.dataType) and f.name != PROCESSING_TIME]
    return F.xxhash64(*hashable)


def latest_per_key(df: DataFrame, keys: Sequence[str] = ("id",), order_by: Sequence[str] = ("ingestion_date",),
                   tiebreak: Sequence[str] | str | None = ROW_HASH) -> DataFrame:
    """Keep one row per key: the greatest ``order_by`` (nulls last).

    Ties on ``order_by`` are broken by ``tiebreak`` columns (descending) or,
    by default, by a hash of the whole row, so reruns pick the same winner.
    ``tiebreak=None`` leaves ties arbitrary. Null keys form one group.
    """
    order = [col(c).desc_nulls_last() for c in order_by]
    if tiebreak == ROW_HASH:
        order.append(row_hash(df).desc())
    elif tiebreak:
        order += [col(c).desc_nulls_last() for c in ([tiebreak] if isinstance(tiebreak, str) else tiebreak)]
    w = Window.partitionBy(*[col(k) for k in keys]).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") == 1).drop("__rn")
