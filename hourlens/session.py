"""Session settings and the shared working folder.

Everything here is a Spark setting; no engine state lives outside the session.
"""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

# Runtime settings every job relies on.  They are session-level SQL settings,
# so they can be applied to a session somebody else created.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session and return it."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(app: str = "hourlens", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or fetch) a session.  On a cluster leave ``master`` unset."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


@cache
def _local_base() -> str:
    return tempfile.mkdtemp(prefix="hourlens-")


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for tables a job must materialise (stages, sinks, state).

    The folder lives under ``spark.checkpoint.dir``, which every executor can
    reach.  Only a local session without that setting gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = _local_base()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
