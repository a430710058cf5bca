"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # Stream state on local disk rather than in executor memory.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Recording the call site of every column operation costs more than building it.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "shiftlab", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on; on a cluster leave ``master`` to spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package on machines where it is not installed."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="shiftlab-code-"), "shiftlab_core.zip")
    with zipfile.ZipFile(target, "w") as out:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.join("shiftlab", os.path.relpath(path, root)))
    spark.sparkContext.addPyFile(target)
    _shipped.add(app)


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder for stream state and stream output.

    It lies under ``spark.checkpoint.dir``, the folder all executors share. Only
    where that is unset on a local master does it fall back to a temporary
    folder; on a cluster an unset folder is an error, because a machine-local
    path would be lost with its machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="shiftlab-")
    return os.path.join(base, f"{purpose}-{uuid.uuid4().hex}")
