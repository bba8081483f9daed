"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

# Settings the operators rely on.  All can be changed on a running session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def ensure_runtime(spark: SparkSession) -> SparkSession:
    """Set UTC and adaptive execution (with skew-join splitting) on a session made elsewhere."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(app: str = "zonelake", master: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    """Build a session; ``master`` is left to spark-submit unless given (tests, bench)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for written intermediates and stream checkpoints.

    It lies under ``spark.checkpoint.dir``, or without that setting in a folder of the warehouse; executors have to be
    able to reach either.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return os.path.join(base, "zonelake", f"{name}-{uuid.uuid4().hex}")
