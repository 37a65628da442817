"""Schema evolution for catalog tables (K3): add new columns, then insert by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quayside.functions.names import quote, resolve
from quayside.operators.upsert import align


def add_missing_columns(spark: SparkSession, table: str, df: DataFrame) -> list[str]:
    """``ALTER TABLE ... ADD COLUMNS`` for every column of ``df`` the table lacks."""
    case_sensitive = str(spark.conf.get("spark.sql.caseSensitive", "false")).lower() == "true"
    existing = spark.table(table).columns
    new = [f for f in df.schema.fields if resolve(f.name, existing, case_sensitive) is None]
    if new:
        cols = ", ".join(f"{quote(f.name)} {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({cols})")
    return [f.name for f in new]


def insert_evolving(spark: SparkSession, table: str, df: DataFrame, overwrite: bool = False) -> list[str]:
    """Evolve the table's schema, then insert ``df`` aligned to it (absent columns null)."""
    added = add_missing_columns(spark, table, df)
    spark.catalog.refreshTable(table)
    target = spark.table(table).schema
    align(df, target).write.insertInto(table, overwrite=overwrite)
    return added
