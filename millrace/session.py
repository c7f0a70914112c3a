"""Session defaults: adaptive execution, ANSI semantics, UTC; sizes follow the cluster, not this file."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

#: Settings that the operators' semantics or plans rely on.
DEFAULTS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(name: str = "millrace", **more: str) -> SparkSession:
    """The running session, or a new one, with the defaults; `more` overrides them."""
    builder = SparkSession.builder.appName(name)
    for key, value in (DEFAULTS | more).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the one that driver and executors share: spark.checkpoint.dir, or the warehouse where that is unset
    (on a local master a temporary folder)."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        local = spark.sparkContext.master.startswith("local[") or spark.sparkContext.master == "local"
        base = "file://" + tempfile.mkdtemp(prefix="millrace-") if local else spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    return f"{base.rstrip('/')}/millrace/stored-{uuid.uuid4().hex}"
