"""Conditional upsert on a key (K4) as a pure DataFrame function.

New state = target rows, where for each key present in the (deduplicated)
updates the update replaces the target row when ``update.order >=
target.order``; keys only in the updates are inserted; all other target rows
are kept. Null keys never match (SQL equality), so a null-key update is always
inserted and null-key target rows are always kept.

One plan at every size: a full-outer equi-join on the key, both sides shuffled
by key once. Null keys are salted, so they never pile up in one hash partition.
Both sides have at most one row per key after deduplication, so the join itself
has no key skew; Spark may still turn it into a broadcast join on its own
statistics.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, StructType

from quayside.errors import ContractError
from quayside.functions.names import col, resolve
from quayside.functions.nested import typed_null
from quayside.operators.latest import ROW_HASH, latest_per_key, row_hash

NULL_KEY_POLICIES = ("keep", "drop", "fail")
NULL_KEY_SALTS = 8192


def _case_sensitive(df: DataFrame) -> bool:
    return str(df.sparkSession.conf.get("spark.sql.caseSensitive", "false")).lower() == "true"


def union_schema(target: StructType, updates: StructType, case_sensitive: bool = False) -> StructType:
    """Target columns (with target types) followed by columns only the updates have."""
    names = target.fieldNames()
    return StructType(list(target.fields)
                      + [f for f in updates.fields if resolve(f.name, names, case_sensitive) is None])


_WHOLE = ["tinyint", "smallint", "int", "bigint"]  # narrow to wide


def keeps_values(source: DataType, target: DataType) -> bool:
    """Whether every value of ``source`` is a value of ``target`` (same type, or a wider number)."""
    a, b = source.simpleString(), target.simpleString()
    if a == b or a == "void" or (a, b) == ("float", "double"):
        return True
    if a in _WHOLE and b in _WHOLE:
        return _WHOLE.index(a) <= _WHOLE.index(b)
    if isinstance(source, DecimalType) and isinstance(target, DecimalType):
        return (target.scale >= source.scale
                and target.precision - target.scale >= source.precision - source.scale)
    return False


def align(df: DataFrame, schema: StructType) -> DataFrame:
    """Project ``df`` onto ``schema``: columns are found by the session's case rule, missing ones are
    typed nulls, narrower numbers are widened. Any other change of type is a :class:`ContractError`:
    a cast could turn values into nulls or truncate them without a trace."""
    case_sensitive = _case_sensitive(df)
    out = []
    for f in schema.fields:
        hit = resolve(f.name, df.columns, case_sensitive)
        if hit is None:
            out.append(typed_null(f.dataType).alias(f.name))
            continue
        source = df.schema[hit].dataType
        if not keeps_values(source, f.dataType):
            raise ContractError(f"column {f.name!r} is {f.dataType.simpleString()} in the table and "
                                f"{source.simpleString()} in the new rows; reload the table to change its type")
        value = col(hit) if source.simpleString() == f.dataType.simpleString() else col(hit).cast(f.dataType)
        out.append(value.alias(f.name))
    return df.select(out)


def upsert(target: DataFrame, updates: DataFrame, key: str = "id", order: str = "ingestion_date", *,
           dedupe: bool = True, tiebreak=ROW_HASH, on_null_key: str = "keep",
           copartition: Callable[[Column, Column], Sequence[Column]] | None = None) -> DataFrame:
    """Return the new target state after merging ``updates`` into ``target``.

    ``copartition`` maps the key and its null-key salt to
    extra join keys that must be functions of the key for non-null keys.
    Both sides are hash-partitioned by those columns alone before the join,
    so a write partitioned by the same columns needs no second shuffle. Spark
    keeps that partitioning for the join only while
    ``spark.sql.requireAllClusterKeysForCoPartition`` is false; otherwise it
    re-partitions by all join keys, with the same result.
    """
    if on_null_key not in NULL_KEY_POLICIES:
        raise ValueError(f"on_null_key must be one of {NULL_KEY_POLICIES}")
    schema = union_schema(target.schema, updates.schema, _case_sensitive(target))
    names = schema.fieldNames()
    t = align(target, schema)
    u = align(updates, schema)
    if dedupe:
        u = latest_per_key(u, [key], [order], tiebreak)
    k = col(key)
    if on_null_key == "drop":
        t, u = t.where(k.isNotNull()), u.where(k.isNotNull())
    elif on_null_key == "fail":
        # A null-key update row fails the job when the result is computed.
        u = u.withColumn(key, F.when(k.isNull(), F.raise_error(F.lit(f"null {key} in updates"))).otherwise(k))
    row = F.struct(*[col(c) for c in names])

    def side(df: DataFrame, name: str) -> DataFrame:
        salt = F.when(k.isNull(), F.pmod(row_hash(df), F.lit(NULL_KEY_SALTS))).otherwise(F.lit(0))
        extra = [c.alias(f"__p{i}") for i, c in enumerate(copartition(k, salt))] if copartition else []
        out = df.select(*extra, k.alias("__k"), salt.alias("__s"), row.alias(name))
        return out.repartition(*[F.col(f"__p{i}") for i in range(len(extra))]) if extra else out

    keys = [f"__p{i}" for i in range(len(copartition(k, F.lit(0))))] if copartition else []
    joined = side(t, "__o").join(side(u, "__u"), [*keys, "__k", "__s"], "full_outer")
    result = joined.select(_chosen(F.col("__o"), F.col("__u"), order).alias("__r"))
    return result.select(*[F.col("__r").getField(c).alias(c) for c in names])


def _chosen(o: Column, n: Column, order: str) -> Column:
    """The update when there is no target row, or when it is not older; else the target row."""
    take_update = o.isNull() | (n.isNotNull() & F.coalesce(n.getField(order) >= o.getField(order), F.lit(False)))
    return F.when(take_update, n).otherwise(o)
