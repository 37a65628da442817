"""The enveloped JSON document scan (S1) and the no-envelope guard (F2).

One file holds one document (pretty-printed or not) or a top-level array of
documents. Every scalar leaf is kept as text (``primitivesAsString``) so
number text such as ``1.50``, ``1e3`` or a 23-digit id survives verbatim;
malformed documents land in a corrupt-record column instead of failing the
scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from quayside.errors import ContractError, NoNewData
from quayside.session import session_conf
from quayside.sources import fs

CORRUPT_COLUMN = "corrupt_record"
SOURCE_PATH = "source_path"


# JSON text cannot contain a raw NUL byte (control characters must be escaped
# inside strings), so with NUL as the record separator every file is exactly
# one record: a whole document (or a top-level array of documents), however
# it is laid out over lines. Records are parsed from their bytes, which keeps
# number tokens as their exact text and is far faster than the multiLine
# reader's stream path for the same result.
_ONE_RECORD_PER_FILE = "\u0000"


CORRUPT_POLICIES = ("count", "fail")


def _reader(spark: SparkSession, corrupt_column: str, recursive: bool, mode: str = "PERMISSIVE"):
    reader = (spark.read.option("lineSep", _ONE_RECORD_PER_FILE)
              .option("primitivesAsString", True)
              .option("mode", mode)
              .option("columnNameOfCorruptRecord", corrupt_column))
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    return reader


def infer_envelope_schema(spark: SparkSession, paths: Sequence[str], *, corrupt_column: str = CORRUPT_COLUMN,
                          recursive: bool = False, settings: dict[str, str] | None = None) -> StructType:
    """Document schema inferred over the files, every scalar leaf as text (one pass). ``settings``: what
    :func:`unsplit_files` gave for these paths, where that is known already."""
    try:
        with session_conf(spark, unsplit_files(spark, paths, recursive) if settings is None else settings):
            return _reader(spark, corrupt_column, recursive).json(list(paths)).schema
    except AnalysisException as exc:
        if "UNABLE_TO_INFER_SCHEMA" in str(exc):  # the folders hold no file at all
            raise NoNewData("no delivery file in the requested folders") from exc
        raise


def read_envelopes(spark: SparkSession, paths: Sequence[str], *, schema: StructType | None = None,
                   corrupt_column: str = CORRUPT_COLUMN, recursive: bool = False,
                   envelope: str | None = None,
                   on_corrupt: str = "count") -> DataFrame:
    """Scan JSON documents, one file = one document or one top-level array of documents.

    The document schema is inferred first (one pass over the files) unless
    ``schema`` is given. Scalars are kept as their exact text (``1.50``,
    ``1e3`` and 23-digit integers survive). Malformed documents keep their
    text in ``corrupt_column``; empty files give no row. ``source_path``
    comes from the scan's ``_metadata``, so it stays right after a shuffle.

    With ``envelope`` set, a missing envelope field raises :class:`NoNewData`
    before the parsing pass. ``on_corrupt="fail"`` parses in ``FAILFAST`` mode:
    a malformed document fails the job that reads it (before any write commits).
    """
    if on_corrupt not in CORRUPT_POLICIES:
        raise ValueError(f"on_corrupt must be one of {CORRUPT_POLICIES}")
    if not paths:
        raise NoNewData("no landing folder to read")
    if schema is None:
        schema = infer_envelope_schema(spark, paths, corrupt_column=corrupt_column, recursive=recursive)
    if envelope is not None and envelope not in schema.fieldNames():
        raise NoNewData(f"no '{envelope}' envelope in the delivery")
    if on_corrupt == "fail":
        schema = StructType([f for f in schema.fields if f.name != corrupt_column])
        raw = _reader(spark, corrupt_column, recursive, "FAILFAST").schema(schema).json(list(paths))
    else:
        if corrupt_column not in schema.fieldNames():
            schema = StructType(list(schema.fields) + [StructField(corrupt_column, StringType())])
        raw = _reader(spark, corrupt_column, recursive).schema(schema).json(list(paths))
    # A document-level field named like the provenance column is replaced by it.
    return raw.select(*[F.col(f"`{c}`") for c in raw.columns if c != SOURCE_PATH],
                      F.col("_metadata.file_path").alias(SOURCE_PATH))


def unsplit_files(spark: SparkSession, paths: Sequence[str], recursive: bool = False) -> dict[str, str]:
    """Session settings under which no task reads a part of a file.

    A file is one record, so a task that begins inside one reads on to its end
    for a separator that never comes. Where the largest file is larger than
    Spark's split size, the split size is raised above it; tasks stay as many
    as the bytes then call for. One listing of the folders, by Spark where they
    are many; empty when no file would be split.
    """
    files, total, largest = fs.sizes(spark, paths, recursive)
    open_cost = _conf_bytes(spark, "spark.sql.files.openCostInBytes")
    most = _conf_bytes(spark, "spark.sql.files.maxPartitionBytes")
    tasks = spark.conf.get("spark.sql.files.minPartitionNum", None) or spark.sparkContext.defaultParallelism
    if largest <= min(most, max(open_cost, (total + files * open_cost) // int(tasks))):
        return {}
    return {"spark.sql.files.maxPartitionBytes": str(largest + 1),
            "spark.sql.files.minPartitionNum": str(max(1, total // (largest + 1)))}


def _conf_bytes(spark: SparkSession, key: str) -> int:
    return int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key)))


def envelope_records_type(df: DataFrame, field: str) -> StructType | None:
    """Element struct of the envelope array; ``None`` when no record shape is known.

    Raises :class:`NoNewData` when the envelope is absent (empty, ``{}`` or
    corrupt-only files) and :class:`ContractError` when it is not an array.
    """
    if field not in df.columns:
        raise NoNewData(f"no '{field}' envelope in the delivery")
    dtype = df.schema[field].dataType
    if not isinstance(dtype, ArrayType):
        raise ContractError(f"envelope '{field}' must be an array of records, found {dtype.simpleString()}")
    if isinstance(dtype.elementType, StructType):
        return dtype.elementType
    return None


def corrupt_documents(spark: SparkSession, paths: Sequence[str], *, recursive: bool = False) -> DataFrame:
    """Files that are not empty yet do not parse as JSON: ``source_path`` and the raw text.

    Reads each file whole as text (a raw JSON scan cannot be queried for its
    corrupt-record column alone). Within an ingest the count is observed on
    the ingest job instead, without this extra read.
    """
    reader = spark.read
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    text = reader.text(list(paths), wholetext=True)
    bad = (F.length(F.trim(F.col("value"))) > 0) & F.try_parse_json(F.col("value")).isNull()
    return text.where(bad).select(F.col("_metadata.file_path").alias(SOURCE_PATH),
                                  F.col("value").alias(CORRUPT_COLUMN))


def corrupt_count(df: DataFrame, corrupt_column: str = CORRUPT_COLUMN):
    """Aggregate counting corrupt documents of a raw scan (for ``observe``)."""
    if corrupt_column not in df.columns:
        return F.lit(0).cast("long").alias("corrupt_documents")
    return F.count_if(F.col(corrupt_column).isNotNull()).alias("corrupt_documents")
