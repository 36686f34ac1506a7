"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_local_scratch: dict[str, str] = {}


def session(app_name: str = "tidemark", **conf: str) -> SparkSession:
    """A session with the settings the library is tuned for; any of them can be overridden."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.parquet.filterPushdown": "true",
        "spark.scheduler.mode": "FAIR",  # tenants share the cluster, see plans/requests.py
        "spark.ui.showConsoleProgress": "false",
    }
    settings.update({key: str(value) for key, value in conf.items()})
    builder = SparkSession.builder.appName(app_name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``.

    A machine-local folder is chosen only where nothing is configured and every task runs in
    the driver's own process; on a cluster the setting is required.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not (context.master == "local" or context.master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    if context.applicationId not in _local_scratch:
        _local_scratch[context.applicationId] = tempfile.mkdtemp(prefix="tidemark-")
    return _local_scratch[context.applicationId]


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the shared scratch folder."""
    return f"{scratch_root(spark)}/{purpose}-{uuid.uuid4().hex}"
