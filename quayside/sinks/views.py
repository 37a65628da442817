"""Published views over output tables (K8)."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from quayside.functions.names import quote
from quayside.sources import fs

#: View property that names the one table made for the view, with its database.
OWNED = "quayside.table"


def view_location(container: str, root_folder: str, folder_name: str) -> tuple[str, str]:
    """(space, path) where a dataset's view is published.

    Master data in the current-state zone is published at the top of its own
    space; everything else goes to ``<container>`` under ``<root_folder>/<folder>``.
    """
    # The folder and the container of the rule's first branch.
    if root_folder == "master" and container == "silver":
        return root_folder, folder_name
    return container, f"{root_folder}/{folder_name}"


def view_name(container: str, root_folder: str, folder_name: str, dataset: str) -> str:
    """A Spark identifier for the dataset's view, derived from its location."""
    space, path = view_location(container, root_folder, folder_name)
    raw = "__".join([space, *path.split("/"), dataset])
    return re.sub(r"[^0-9A-Za-z_]", "_", raw)


def publish_view(spark: SparkSession, name: str, path: str, *, persistent: bool = False,
                 schema: StructType | None = None, partitions: Sequence[str] = ()) -> str:
    """Create or replace a view over the parquet table at ``path``; readers switch atomically.

    The view has the columns of ``schema``, by default of all files. Temporary
    views (default) resolve the table when they are created, so call this
    after every publication. ``persistent=True`` keeps the view in the session
    catalog; ``partitions`` then names the table's partition columns.
    """
    reader = spark.read.option("mergeSchema", True) if schema is None else spark.read.schema(schema)
    df = reader.parquet(path)
    if not persistent:
        df.createOrReplaceTempView(name)
        return name
    root = path.rstrip("/")
    folders = [root]
    for p in partitions:
        folders = [e.path for f in folders for e in fs.list_dir(spark, f) if e.is_dir and e.name.startswith(f"{p}=")]
    return _publish_files(spark, name, root, df.schema, list(partitions), folders if partitions else [], df.columns)


def publish_over(spark: SparkSession, name: str, source: str, *, persistent: bool = True) -> str:
    """A view over a catalog table or view. A persistent one follows it, whatever becomes of its
    partitions and files."""
    if not persistent:
        spark.table(source).createOrReplaceTempView(name)
        return name
    own, other = ('.'.join(split_quoted(spark, n)) for n in (name, source))
    spark.sql(f"CREATE OR REPLACE VIEW {own} AS SELECT * FROM {other}")
    return name


def publish_current(spark: SparkSession, name: str, table, *, persistent: bool = False) -> str:
    """A further view over a current state. A temporary view shows the build that was live when it was made."""
    if not persistent:
        table.read(spark).createOrReplaceTempView(name)
        return name
    return publish_over(spark, name, table.name)


def split_name(spark: SparkSession, name: str) -> tuple[str, str]:
    """Database (quoted) and bare name of a table or view; without a database, the session's current one."""
    *db, last = name.split(".")
    return ".".join(map(quote, db or [spark.catalog.currentDatabase()])), last


def split_quoted(spark: SparkSession, name: str) -> tuple[str, str]:
    db, last = split_name(spark, name)
    return db, quote(last)


def owned_table(spark: SparkSession, name: str) -> tuple[str, dict[str, str]] | None:
    """The table that was made for a catalog view, and the view's properties; None without such a view."""
    full = ".".join(split_quoted(spark, name))
    if not spark.catalog.tableExists(full):
        return None
    properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {full}").collect()}
    return properties.get(OWNED, ""), properties


def create_view(spark: SparkSession, name: str, query: str, owned: str, properties: dict[str, str]) -> None:
    """Create or replace a catalog view in one step. ``owned``: the table made for it."""
    listed = ", ".join(f"'{k}' = '{v}'" for k, v in {OWNED: owned, **properties}.items())
    spark.sql(f"CREATE OR REPLACE VIEW {'.'.join(split_quoted(spark, name))} TBLPROPERTIES ({listed}) AS {query}")


def _publish_files(spark: SparkSession, name: str, root: str, schema: StructType, partitions: list[str],
                   folders: list[str], columns: list[str]) -> str:
    """A view over a catalog table that has a schema of its own and lists just these folders. The view
    is replaced in one step; the table that it names as its own is dropped then (its files are not)."""
    db, last = split_name(spark, name)
    behind = f"{db}.{quote(f'{last}__files_{uuid.uuid4().hex[:8]}')}"
    fields = ", ".join(f"{quote(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    by = f"PARTITIONED BY ({', '.join(quote(p) for p in partitions)})" if partitions else ""
    spark.sql(f"CREATE TABLE {behind} ({fields}) USING parquet {by} LOCATION '{root}'")
    for at in range(0, len(folders), 200):
        parts = []
        for f in folders[at : at + 200]:
            values = dict(x.split("=", 1) for x in f.rsplit("/", len(partitions))[1:])
            spec = ", ".join(f"{quote(p)}='{unquote(values[p])}'" for p in partitions)
            parts.append(f"PARTITION ({spec}) LOCATION '{f}'")
        spark.sql(f"ALTER TABLE {behind} ADD {' '.join(parts)}")
    old = owned_table(spark, name)
    create_view(spark, name, f"SELECT {', '.join(quote(c) for c in columns)} FROM {behind}", behind, {})
    if old and old[0] and "__files_" in old[0]:  # exactly the table that the view had before
        spark.sql(f"DROP TABLE IF EXISTS {old[0]}")
    return name
