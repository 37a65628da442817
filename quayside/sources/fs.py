"""File-system metadata: Spark's own file listing, and calls of Hadoop's FileSystem API.

No file content is read here. Listings of many folders are Spark's, which
lists them in parallel and keeps the rows on the executors; the driver's
calls are for single folders. Works for every Hadoop-supported scheme (file, hdfs, s3a,
abfss, gs, ...).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.session import session_conf


@dataclass(frozen=True)
class Entry:
    path: str
    name: str
    is_dir: bool
    length: int


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def _entry(status) -> Entry:
    p = status.getPath()
    return Entry(p.toString(), p.getName(), bool(status.isDirectory()), int(status.getLen()))


def exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = _fs(spark, path)
    return bool(fs.exists(hpath))


def list_dir(spark: SparkSession, path: str) -> list[Entry]:
    """Direct children of ``path``; a missing path lists as empty."""
    fs, hpath = _fs(spark, path)
    if not fs.exists(hpath):
        return []
    return sorted((_entry(s) for s in fs.listStatus(hpath)), key=lambda e: e.path)


def is_nonempty(spark: SparkSession, path: str) -> bool:
    """True when ``path`` exists and has at least one child (a folder) or bytes (a file)."""
    fs, hpath = _fs(spark, path)
    if not fs.exists(hpath):
        return False
    status = fs.getFileStatus(hpath)
    if not status.isDirectory():
        return status.getLen() > 0
    return len(fs.listStatus(hpath)) > 0


def list_files_recursive(spark: SparkSession, path: str) -> list[Entry]:
    """Every file below ``path``; a missing root lists as empty."""
    fs, hpath = _fs(spark, path)
    if not fs.exists(hpath):
        return []
    it = fs.listFiles(hpath, True)
    out = []
    while it.hasNext():
        out.append(_entry(it.next()))
    return sorted(out, key=lambda e: e.path)


def file_table(spark: SparkSession, paths: Sequence[str], recursive: bool = False) -> DataFrame:
    """path, length, modificationTime of the files that a read of ``paths`` finds (names that begin with
    ``_`` or ``.`` are not read). Spark lists the folders, in parallel where there are many, and opens no
    file. A missing path is an ``AnalysisException``, as it is for the read."""
    reader = spark.read.format("binaryFile")
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    return reader.load(list(paths)).select("path", "length", "modificationTime")


def sizes(spark: SparkSession, paths: Sequence[str], recursive: bool = False) -> tuple[int, int, int]:
    """Number, total length and greatest length of the files in the folders. Few folders are listed by the
    driver, as Spark does itself; more of them by :func:`file_table`, of which one row comes back."""
    if len(paths) <= int(spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.threshold")) and not recursive:
        lengths = [e.length for p in paths for e in list_dir(spark, p) if not e.is_dir]
        return len(lengths), sum(lengths), max(lengths, default=0)
    found = file_table(spark, paths, recursive).agg(
        F.count("*"), F.coalesce(F.sum("length"), F.lit(0)), F.coalesce(F.max("length"), F.lit(0)))
    with session_conf(spark, {"spark.sql.files.maxPartitionBytes": str(1 << 50)}):  # tasks by cores, not by bytes
        return tuple(found.first())


def fingerprint(spark: SparkSession, path: str) -> str:
    """Names, sizes and times of the files of a small folder, or of one file."""
    fs, hpath = _fs(spark, path)
    found = [f"{s.getPath()}|{s.getLen()}|{s.getModificationTime()}" for s in fs.listStatus(hpath)]
    return "\n".join(sorted(found))


def make_dir(spark: SparkSession, path: str) -> None:
    fs, hpath = _fs(spark, path)
    fs.mkdirs(hpath)


def rename(spark: SparkSession, src: str, dst: str) -> None:
    fs, hsrc = _fs(spark, src)
    _, hdst = _fs(spark, dst)
    parent = hdst.getParent()
    if parent is not None and not fs.exists(parent):
        fs.mkdirs(parent)
    if not fs.rename(hsrc, hdst):
        raise OSError(f"rename failed: {src} -> {dst}")


def delete(spark: SparkSession, path: str) -> bool:
    fs, hpath = _fs(spark, path)
    return bool(fs.delete(hpath, True))


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small marker/pointer file: a temporary file, then one rename that replaces the old
    file, so that a reader or a crash finds the old text or the new one, never neither."""
    fs, hpath = _fs(spark, path)
    _, tmp = _fs(spark, f"{path}.tmp-{uuid.uuid4().hex[:8]}")
    out = fs.create(tmp, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    jvm = spark.sparkContext._jvm
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf).rename(
        fs.makeQualified(tmp), fs.makeQualified(hpath), how)


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, hpath = _fs(spark, path)
    if not fs.exists(hpath):
        return None
    jvm = spark.sparkContext._jvm
    stream = fs.open(hpath)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
