"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime join choice is left to adaptive execution: it broadcasts a side only
# after measuring it, and splits a hot join partition even if that costs a shuffle.
ADAPTIVE_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def build_session(app: str = "gearyard", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    fixed = {"spark.sql.session.timeZone": "UTC", "spark.python.sql.dataFrameDebugging.enabled": "false"}
    for key, value in {**ADAPTIVE_SETTINGS, **fixed, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def adapt(spark: SparkSession) -> None:
    """Turn the adaptive settings on in a session someone else built."""
    for key, value in ADAPTIVE_SETTINGS.items():
        spark.conf.set(key, value)


def scratch_dir(spark: SparkSession) -> str:
    """A fresh sub-folder of the shared folder named by ``spark.checkpoint.dir``.

    Without that setting a temporary folder is used, but only in local mode,
    where driver and executors are one machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/gearyard-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return tempfile.mkdtemp(prefix="gearyard-")
