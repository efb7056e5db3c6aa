"""Session settings the library expects, and the shared work folder it may write to."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import SparkSession

_LOCAL_ROOTS: dict[str, str] = {}


def build_session(app: str = "tallyline", master: str | None = None, shuffle_partitions: int | None = None,
                  **conf: str) -> SparkSession:
    """A session with AQE, UTC and zone-less Parquet timestamps. Cluster sizing stays with the submitter."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder for written intermediate tables: ``spark.checkpoint.dir``, the one every executor can reach.

    Only a local-mode session without that setting gets a throw-away folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = context.applicationId
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="tallyline-")
        atexit.register(shutil.rmtree, _LOCAL_ROOTS[app], ignore_errors=True)
    return _LOCAL_ROOTS[app]
