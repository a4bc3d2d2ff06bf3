"""Session settings the operators rely on, and the shared folder for written state."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_ROOTS: dict[str, str] = {}


def build_session(app: str = "sluiceway", cores: int | str = "*", **conf: str) -> SparkSession:
    """Local session for tests and benches; a cluster passes its own session instead."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for staged data: `spark.checkpoint.dir` as the cluster names it.

    Only a local master may fall back to a temporary folder; on a cluster a
    machine-local path would be invisible to the other executors.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.conf.get("spark.master", "local")
    if not master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder when running on a cluster")
    app = spark.conf.get("spark.app.id", str(os.getpid()))
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="sluiceway-")
    return _LOCAL_ROOTS[app]


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh, unique sub-folder of the shared folder."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"
