"""Dataset contract: the source-side schema and the list of target field rules.

JSON shape::

    {"origin_conf": <Spark StructType JSON>,
     "fields": [{"name": ..., "type": ..., "source_name" | "expression": ...,
                 "metadata": {"timestamp_definition" | "date_definition": ...}}, ...]}
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import SparkSession
from pyspark.sql.types import StructField, StructType

from quayside.errors import ContractError
from quayside.functions.casts import parse_field
from quayside.sources import fs


@dataclass
class Contract:
    origin_schema: StructType
    fields: list[dict[str, Any]] = field(default_factory=list)

    @classmethod
    def from_dict(cls, data: dict[str, Any]) -> "Contract":
        if "origin_conf" not in data or "fields" not in data:
            raise ContractError("contract needs 'origin_conf' and 'fields'")
        origin = data["origin_conf"]
        if isinstance(origin, str):
            origin = json.loads(origin)
        try:
            schema = StructType.fromJson(_with_defaults(origin))
        except Exception as exc:
            raise ContractError(f"bad origin_conf: {exc}") from exc
        rules = list(data["fields"])
        for rule in rules:
            parse_field(rule)
        return cls(schema, rules)

    @classmethod
    def from_json(cls, text: str) -> "Contract":
        return cls.from_dict(json.loads(text))

    @classmethod
    def load(cls, path: str, spark: SparkSession | None = None) -> "Contract":
        """Read the contract from any file system that Spark reads (the active session's by default)."""
        text = fs.read_text(spark or SparkSession.getActiveSession(), str(path))
        if text is None:
            raise FileNotFoundError(path)
        return cls.from_json(text)

    def target_schema(self) -> StructType:
        return StructType([parse_field(r) for r in self.fields])


def _with_defaults(schema_json: dict[str, Any]) -> dict[str, Any]:
    """Fill ``nullable``/``metadata`` that ``StructType.fromJson`` insists on."""
    def fix(dtype):
        if isinstance(dtype, dict) and dtype.get("type") == "struct":
            return {"type": "struct", "fields": [
                {"name": f["name"], "type": fix(f["type"]), "nullable": f.get("nullable", True),
                 "metadata": f.get("metadata") or {}} for f in dtype.get("fields", [])]}
        if isinstance(dtype, dict) and dtype.get("type") == "array":
            return {**dtype, "elementType": fix(dtype["elementType"]), "containsNull": dtype.get("containsNull", True)}
        if isinstance(dtype, dict) and dtype.get("type") == "map":
            return {**dtype, "keyType": fix(dtype["keyType"]), "valueType": fix(dtype["valueType"]),
                    "valueContainsNull": dtype.get("valueContainsNull", True)}
        return dtype
    return fix(schema_json)


__all__ = ["Contract", "StructField"]
