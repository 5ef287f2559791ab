"""Session settings and the shared folder that jobs write intermediate tables to."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    # Event times are UTC instants; every calendar expression relies on it.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

_local_roots: dict[str, str] = {}


def build_session(app_name="ledgerline", master=None, conf=None) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        # Recording the call site of every column costs more than planning the queries here.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_settings(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Runtime settings for the jobs and streams started inside; the session's own come back after."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A temporary folder stands in for it in local mode only; a cluster without the setting is
    refused, since a machine-local folder would lose its files together with the machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the whole cluster")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="ledgerline-")
    return _local_roots[app]


def new_run_dir(spark: SparkSession, purpose: str) -> str:
    return f"{shared_root(spark)}/ledgerline/{purpose}-{uuid.uuid4().hex}"
