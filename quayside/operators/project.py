"""Projections: name lists (P5), all-text (P6), conform (P7) and contract projection."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, DataType, StringType, StructType

from quayside.functions.casts import field_column, parse_field
from quayside.functions.names import col, resolve
from quayside.functions.nested import conform, is_struct_like, lost, typed_null
from quayside.operators.lineage import INGESTION_DATE, LINEAGE_COLUMNS


LOST_PREFIX = "__lost_"


def _case_sensitive(df: DataFrame) -> bool:
    return str(df.sparkSession.conf.get("spark.sql.caseSensitive", "false")).lower() == "true"


def select_columns(df: DataFrame, names: Sequence[str], missing_type: DataType = StringType()) -> DataFrame:
    """Project to ``names``; an absent name becomes a typed null (string by default)."""
    return df.select([col(n) if n in df.columns else typed_null(missing_type).alias(n) for n in names])


def all_as_text(df: DataFrame, keep: Sequence[str] = LINEAGE_COLUMNS) -> DataFrame:
    """Cast every data column to string; lineage columns keep their types."""
    return df.select([col(c) if c in keep else col(c).cast("string").alias(c) for c in df.columns])


def conform_to_schema(df: DataFrame, schema: StructType, keep: Sequence[str] = (INGESTION_DATE,),
                      strict: bool = False, loss_flags: bool = False) -> DataFrame:
    """Keep exactly the declared columns, in declared order, plus ``keep``.

    Absent columns become typed nulls; structs and arrays of structs are
    re-shaped to the declared type by name (from JSON text or from a nested
    value); other declared columns pass through unchanged (the contract
    projection casts them). Names resolve with the session's case rule.
    ``strict`` fails the job on nested values that do not fit; with
    ``loss_flags`` a ``__lost_<name>`` column says where one lost something.
    """
    case_sensitive = _case_sensitive(df)
    names = df.columns
    out, flags = [], []
    for f in schema.fields:
        hit = resolve(f.name, names, case_sensitive)
        if hit is None:
            out.append(typed_null(f.dataType).alias(f.name))
        elif is_struct_like(f.dataType):
            source = df.schema[hit].dataType
            out.append(conform(col(hit), source, f.dataType, case_sensitive=case_sensitive, strict=strict).alias(f.name))
            if loss_flags and not strict:
                flags.append(lost(col(hit), source, f.dataType, case_sensitive).alias(LOST_PREFIX + f.name))
        else:
            out.append(col(hit).alias(f.name))
    out += [col(k) for k in keep if k in names and k not in schema.fieldNames()]
    return df.select(out + flags)


def apply_contract(df: DataFrame, fields: Sequence[dict[str, Any]], keep: Sequence[str] = (INGESTION_DATE,),
                   strict: bool = False, loss_flags: bool = False) -> DataFrame:
    """One output column per field rule (renamed and typed), plus ``keep`` columns.

    With ``loss_flags`` a boolean ``__lost_<name>`` column is added per rule that
    reads a source column: true where the source has a value and the typed
    result is null (a lenient cast or pattern that did not fit). They are
    computed in the same projection, for counting on the run's own job.
    """
    case_sensitive = _case_sensitive(df)
    cols = [field_column(rule, df.schema, strict=strict, case_sensitive=case_sensitive) for rule in fields]
    declared = {rule["name"] for rule in fields}
    out = cols + [col(k) for k in keep if k in df.columns and k not in declared]
    if loss_flags:
        for rule, typed in zip(fields, cols):
            source = None if rule.get("expression") else resolve(rule.get("source_name") or "", df.columns,
                                                                  case_sensitive)
            if source is not None:
                flag = col(source).isNotNull() & typed.isNull()
                target = parse_field(rule).dataType
                if isinstance(target, (StructType, ArrayType)):
                    flag = flag | lost(col(source), df.schema[source].dataType, target, case_sensitive)
                earlier = LOST_PREFIX + source  # what conforming the source column already lost
                flag = flag | col(earlier) if earlier in df.columns else flag
                out.append(flag.alias(LOST_PREFIX + rule["name"]))
    return df.select(out)
