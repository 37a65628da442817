"""Contract field rules (P9-P14): one target column per declared field.

Rule order: an ``expression`` wins over everything; then plain casts for the
auto-cast types; then timestamps (zone-less text -> UTC, zone from a column or
a literal); then dates by pattern; anything else is rejected. All checks run
while columns are built, so a bad contract fails before any Spark job.

Casts are lenient by default (``try_cast`` family: bad text -> null). With
``strict=True`` plain casts are used and bad values fail the job (ANSI).
"""

from __future__ import annotations

import re
import zoneinfo
from typing import Any

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BinaryType, BooleanType, ByteType, DataType, DateType,
                               DecimalType, DoubleType, FloatType, IntegerType, LongType, NullType,
                               ShortType, StringType, StructField, StructType, TimestampType)

from quayside.errors import ContractError
from quayside.functions.names import col, resolve
from quayside.functions.nested import conform

# The target types reached by a plain cast (same list as the reference).
AUTO_CAST_TYPES = (
    NullType, StringType, BinaryType, BooleanType,
    DecimalType, DoubleType, FloatType,
    ByteType, IntegerType,
    LongType, ShortType, StructType, ArrayType,
)

# The short zone aliases Java's ZoneId.SHORT_IDS maps to regions,
# which Spark accepts wherever it takes a zone id.
JAVA_SHORT_ZONE_IDS = frozenset({
    "ACT", "AET", "AGT", "ART", "AST", "BET", "BST", "CAT", "CNT", "CST", "CTT", "EAT", "ECT", "EST",
    "HST", "IET", "IST", "JST", "MIT", "MST", "NET", "NST", "PLT", "PNT", "PRT", "PST", "SST", "VST",
})

# The pattern letters Spark's datetime parser documents for
# parsing; week-based and other legacy letters are refused by Spark at run time.
DATETIME_PATTERN_LETTERS = frozenset("GyDMLdQqEFahKkHmsSVzOXxZ")

# Text ending in an explicit zone designator: Z, or a numeric offset such as +02:00 / -0500.
ZONE_IN_TEXT = r"(Z|[+-][0-9]{2}(:?[0-9]{2})?)$"

_OFFSET_ZONE = re.compile(r"^(?:(?:UTC|GMT|UT)?[+-]\d{1,2}(?::?\d{2}){0,2}|Z|UTC|GMT|UT)$")


def parse_field(rule: dict[str, Any]) -> StructField:
    """The rule's name and type as a ``StructField`` (extra keys ignored)."""
    if "name" not in rule or "type" not in rule:
        raise ContractError(f"field rule needs 'name' and 'type': {rule}")
    data = {"name": rule["name"], "type": rule["type"],
            "nullable": rule.get("nullable", True), "metadata": rule.get("metadata") or {}}
    try:
        return StructField.fromJson(data)
    except Exception as exc:
        if not isinstance(rule["type"], str):
            raise ContractError(f"bad type for field {rule['name']!r}: {rule['type']!r}") from exc
    try:  # DDL spelling ("int", "map<string,int>") as a fallback to the JSON type names
        return StructField(data["name"], DataType.fromDDL(rule["type"]), data["nullable"], data["metadata"])
    except Exception as exc:
        raise ContractError(f"bad type for field {rule['name']!r}: {rule['type']!r}") from exc


def check_zone_id(zone: str) -> str:
    """Validate a literal zone: region id (``Europe/Paris``) or a fixed offset."""
    if not isinstance(zone, str) or not zone:
        raise ContractError(f"bad time zone literal {zone!r}")
    if _OFFSET_ZONE.match(zone) or zone in JAVA_SHORT_ZONE_IDS:
        return zone
    try:
        zoneinfo.ZoneInfo(zone)
    except (zoneinfo.ZoneInfoNotFoundError, ValueError) as exc:
        raise ContractError(f"unknown time zone {zone!r}") from exc
    return zone


def check_date_pattern(pattern: str) -> str:
    """Reject a date pattern whose letters Spark cannot parse with (quoted text is literal)."""
    if not isinstance(pattern, str) or not pattern:
        raise ContractError(f"bad date pattern {pattern!r}")
    unquoted = re.sub(r"'[^']*'", "", pattern)
    bad = sorted({ch for ch in unquoted if ch.isascii() and ch.isalpha() and ch not in DATETIME_PATTERN_LETTERS})
    if bad:
        raise ContractError(f"unsupported letters {bad} in date pattern {pattern!r}")
    return pattern


def is_zone(zone: Column) -> Column:
    """Whether a zone id is one that Spark's zone functions accept; null for null."""
    ids = SparkSession.active()._jvm.java.time.ZoneId
    known = SparkSession.active()._jvm.java.util.HashSet(ids.getAvailableZoneIds())
    known.addAll(ids.SHORT_IDS.keySet())
    # the set stays in the JVM: hundreds of literals made one by one take a second
    return type(zone)(zone._jc.isInCollection(known)) | zone.rlike(_OFFSET_ZONE.pattern)


def _definition(rule: dict[str, Any], key: str) -> dict[str, Any]:
    meta = rule.get("metadata") or {}
    if key not in meta:
        raise ContractError(f"field {rule['name']!r} needs metadata.{key}")
    return meta[key]


def _source(rule: dict[str, Any], schema: StructType, case_sensitive: bool) -> tuple[Column, DataType | None]:
    name = rule.get("source_name")
    if not name:
        raise ContractError(f"field {rule['name']!r} needs 'source_name' or 'expression'")
    hit = resolve(name, schema.fieldNames(), case_sensitive)
    if hit is None:
        raise ContractError(f"source column {name!r} of field {rule['name']!r} is not in the conformed schema")
    return col(hit), schema[hit].dataType


def _cast(value: Column, source: DataType | None, target: DataType, strict: bool, case_sensitive: bool = False) -> Column:
    if isinstance(target, (StructType, ArrayType)) and source is not None:
        # By-name rebuild (a plain struct cast is positional, and text cannot be cast to a struct).
        return conform(value, source, target, case_sensitive=case_sensitive, strict=strict)
    if source is not None and source == target:
        return value
    return value.cast(target) if strict else value.try_cast(target)


def field_column(rule: dict[str, Any], schema: StructType, *, strict: bool = False,
                 case_sensitive: bool = False) -> Column:
    """Build the target column for one field rule over a frame of ``schema``."""
    target = parse_field(rule)
    dtype, name = target.dataType, target.name
    if rule.get("expression"):
        return _cast(F.expr(rule["expression"]), None, dtype, strict).alias(name)
    if isinstance(dtype, AUTO_CAST_TYPES):
        value, source = _source(rule, schema, case_sensitive)
        return _cast(value, source, dtype, strict, case_sensitive).alias(name)
    if isinstance(dtype, TimestampType):
        definition = _definition(rule, "timestamp_definition")
        source_format = definition.get("source_format") or {}
        zone = definition.get("timezone") or {}
        if source_format.get("type") != "string":
            raise ContractError(f"field {name!r}: a timestamp's source_format must be of type 'string', not {source_format}")
        value, _ = _source(rule, schema, case_sensitive)
        parsed = F.to_timestamp(value) if strict else F.try_to_timestamp(value)
        if zone.get("type") == "field":
            zone_col = resolve(zone.get("value", ""), schema.fieldNames(), case_sensitive)
            if zone_col is None:
                raise ContractError(f"zone column {zone.get('value')!r} of field {name!r} is not in the conformed schema")
            shifted = F.to_utc_timestamp(parsed, col(zone_col))
            if not strict:  # an unknown zone would fail the job: the value is lost instead, and counted
                shifted = F.when(is_zone(col(zone_col)), shifted)
        elif zone.get("type") == "literal":
            shifted = F.to_utc_timestamp(parsed, F.lit(check_zone_id(zone.get("value"))))
        else:
            raise ContractError(f"field {name!r}: timezone must be a 'field' or a 'literal', not {zone}")
        if definition.get("respect_zone_in_text"):
            # Opt-in: text that states its own zone (Z or an offset) is already an instant.
            shifted = F.when(value.rlike(ZONE_IN_TEXT), parsed).otherwise(shifted)
        return shifted.alias(name)
    if isinstance(dtype, DateType):
        definition = _definition(rule, "date_definition")
        source_format = definition.get("source_format") or {}
        if source_format.get("type") != "string" or not source_format.get("date_format"):
            raise ContractError(f"field {name!r}: a date needs a source_format of type 'string' with a date_format, "
                                f"not {source_format}")
        value, _ = _source(rule, schema, case_sensitive)
        pattern = check_date_pattern(source_format["date_format"])
        return (F.to_date(value, pattern) if strict else F.try_to_date(value, pattern)).alias(name)
    raise ContractError(f"field {name!r}: no rule makes a {dtype.simpleString()}; use an expression")
