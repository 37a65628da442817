"""Session settings the pipelines depend on, and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Timestamps are parsed from zone-less text and shifted with to_utc_timestamp,
# which is only right when the session zone is UTC.
PIPELINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.legacy.timeParserPolicy": "CORRECTED",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the session settings the pipelines require (idempotent)."""
    for key, value in PIPELINE_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder named by ``spark.checkpoint.dir``.

    Scratch tables and lineage cuts go there, never to a machine-local
    folder. Only when the setting is absent on a ``local`` master (tests) is
    a temporary folder created; on a cluster the setting is required.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if configured:
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", str(sc.master)):  # local-cluster has executors of its own
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach "
                           "(staging tables and stream checkpoints are written there)")
    local = tempfile.mkdtemp(prefix="quayside-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path below ``<shared dir>/quayside``."""
    return "/".join([shared_dir(spark), "quayside", *parts])


def new_scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique path below the shared scratch folder."""
    return scratch_path(spark, "runs", f"{label}-{uuid.uuid4().hex[:12]}")


@contextmanager
def session_conf(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Set SQL confs for the actions run inside the block, then restore them."""
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
