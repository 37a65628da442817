"""Nested values: JSON-text serialisation and typed re-shaping to a declared schema."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructField, StructType

from quayside.errors import ContractError
from quayside.functions.names import col, resolve


def is_nested(dtype: DataType) -> bool:
    """Structs and all arrays (history-table rule)."""
    return isinstance(dtype, (StructType, ArrayType))


def is_struct_like(dtype: DataType) -> bool:
    """Structs and arrays of structs only (arrays of scalars stay arrays)."""
    return isinstance(dtype, StructType) or (
        isinstance(dtype, ArrayType) and isinstance(dtype.elementType, StructType))


def nested_to_json(df: DataFrame, predicate: Callable[[DataType], bool] = is_nested) -> DataFrame:
    """Serialise every top-level column whose type matches ``predicate`` to JSON text.

    ``to_json`` drops null struct fields and keeps nulls inside arrays.
    """
    return df.select([
        F.to_json(col(f.name)).alias(f.name) if predicate(f.dataType) else col(f.name)
        for f in df.schema.fields
    ])


def text_leaves(dtype: DataType) -> DataType:
    """Same shape as ``dtype`` with every scalar leaf replaced by string."""
    if isinstance(dtype, StructType):
        return StructType([StructField(f.name, text_leaves(f.dataType), True) for f in dtype.fields])
    if isinstance(dtype, ArrayType):
        return ArrayType(text_leaves(dtype.elementType), True)
    if isinstance(dtype, MapType):
        return MapType(StringType(), text_leaves(dtype.valueType), True)
    return StringType()


def typed_null(dtype: DataType) -> Column:
    return F.lit(None).cast(dtype)


def conform(value: Column, source: DataType, target: DataType, *, cast_leaves: bool = True,
            case_sensitive: bool = False, strict: bool = False) -> Column:
    """Rebuild ``value`` (of type ``source``) into ``target`` by field name.

    * JSON text becomes the declared struct/array/map: parsed with all-text
      leaves first, then each leaf converted with ``try_cast`` so numeric text
      such as ``"12"`` becomes ``12`` rather than null.
    * Structs keep declared fields in declared order; absent fields are typed
      nulls, undeclared fields are dropped; a null struct stays null.
    * Arrays are rebuilt element by element with ``transform``.
    * Text that is no JSON is a typed null.
    * ``strict``: such text, and leaves that do not fit, fail the job instead.
    * Scalars are ``try_cast`` when ``cast_leaves`` and the types differ.
    """
    if isinstance(target, (StructType, ArrayType, MapType)) and isinstance(source, StringType):
        parse_as = text_leaves(target)
        parsed = F.from_json(value, parse_as, {"mode": "FAILFAST"} if strict else {})
        made = conform(parsed, parse_as, target, cast_leaves=cast_leaves, case_sensitive=case_sensitive, strict=strict)
        return made if strict else F.when(F.try_parse_json(value).isNotNull(), made)
    if isinstance(target, StructType):
        if not isinstance(source, StructType):
            raise ContractError(f"cannot re-shape {source.simpleString()} into {target.simpleString()}")
        names = source.fieldNames()
        parts = []
        for f in target.fields:
            hit = resolve(f.name, names, case_sensitive)
            if hit is None:
                parts.append(typed_null(f.dataType).alias(f.name))
            else:
                parts.append(conform(value.getField(hit), source[hit].dataType, f.dataType,
                                     cast_leaves=cast_leaves, case_sensitive=case_sensitive, strict=strict).alias(f.name))
        return F.when(value.isNull(), typed_null(target)).otherwise(F.struct(*parts))
    if isinstance(target, ArrayType):
        if not isinstance(source, ArrayType):
            raise ContractError(f"cannot re-shape {source.simpleString()} into {target.simpleString()}")
        return F.transform(value, lambda x: conform(x, source.elementType, target.elementType,
                                                     cast_leaves=cast_leaves, case_sensitive=case_sensitive,
                                                     strict=strict))
    if isinstance(target, MapType):
        if not isinstance(source, MapType):
            raise ContractError(f"cannot re-shape {source.simpleString()} into {target.simpleString()}")
        keyed = value if source.keyType == target.keyType else F.transform_keys(
            value, lambda k, v: k.cast(target.keyType) if strict else k.try_cast(target.keyType))
        return F.transform_values(keyed, lambda k, v: conform(v, source.valueType, target.valueType,
                                                              cast_leaves=cast_leaves, case_sensitive=case_sensitive,
                                                     strict=strict))
    if source == target or not cast_leaves:
        return value
    return value.cast(target) if strict else value.try_cast(target)


def lost(value: Column, source: DataType, target: DataType, case_sensitive: bool = False) -> Column:
    """Whether a lenient :func:`conform` loses something of ``value``: text that is no JSON, or a leaf
    that does not fit its type. Never null."""
    no = F.lit(False)
    if isinstance(target, (StructType, ArrayType, MapType)) and isinstance(source, StringType):
        parse_as = text_leaves(target)
        inner = lost(F.from_json(value, parse_as), parse_as, target, case_sensitive)
        return value.isNotNull() & (F.try_parse_json(value).isNull() | inner)
    if isinstance(target, StructType) and isinstance(source, StructType):
        hits = [(resolve(f.name, source.fieldNames(), case_sensitive), f) for f in target.fields]
        out = no
        for hit, f in hits:
            if hit is not None:
                out = out | lost(value.getField(hit), source[hit].dataType, f.dataType, case_sensitive)
        return F.coalesce(out, no)
    if isinstance(target, ArrayType) and isinstance(source, ArrayType):
        return F.coalesce(F.exists(value, lambda x: lost(x, source.elementType, target.elementType, case_sensitive)), no)
    if isinstance(target, MapType) and isinstance(source, MapType):
        return F.coalesce(F.exists(F.map_values(value),
                                   lambda x: lost(x, source.valueType, target.valueType, case_sensitive)), no)
    return no if source == target else value.isNotNull() & value.try_cast(target).isNull()
