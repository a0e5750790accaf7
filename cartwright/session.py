"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that can be changed on a running session. ANSI mode turns overflow into
# an error instead of a wrong number; forceOptimizeSkewedJoin lets AQE split a hot
# customer even when the split costs one more shuffle.
RUNTIME_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def build_session(
    app_name: str = "cartwright",
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build a session; ``master`` stays with spark-submit unless given.

    The driver address is only pinned for a local master, where there are no
    remote executors that have to reach it.
    """
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
        if master.startswith("local"):
            builder = (
                builder.config("spark.driver.host", "127.0.0.1")
                .config("spark.driver.bindAddress", "127.0.0.1")
                .config("spark.ui.enabled", "false")
            )
    for key, value in {**RUNTIME_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings the results depend on to a session built elsewhere."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


_local_root: str | None = None


def shared_root(spark: SparkSession) -> str:
    """Folder that every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of this machine.
    """
    global _local_root
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="cartwright-")
    return _local_root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other call returns."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
