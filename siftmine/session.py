"""Session helper and the folder that all executors can reach."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession

#: Bytes of an Arrow batch, so that wide rows come to Python few at a time.
BATCH_BYTES = "8MB"


def build_session(app_name: str, master: str | None = None, **conf) -> SparkSession:
    """A session with adaptive execution; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        # Streaming state on local disk instead of the executors' heap.
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
    }
    settings.update({key.replace("__", "."): str(value) for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def small_batches(spark: SparkSession) -> None:
    """Let the session cut Arrow batches at ``BATCH_BYTES``, unless it has a setting of its own."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, BATCH_BYTES)


def runs_alone(master: str) -> bool:
    """Whether the master stands for a single process."""
    return re.fullmatch(r"local(\[.*\])?", master) is not None


def shared_folder(spark: SparkSession) -> str:
    """Folder for checkpoints and intermediate tables, which all executors can reach.

    The cluster names it in ``spark.checkpoint.dir``. Where that is unset in a
    session of one machine, it is a folder in Spark's warehouse; on a cluster
    that is an error, as the warehouse may be a folder of the driver's machine.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not runs_alone(context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors can reach")
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_siftmine"
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def run_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name for one use, below one folder per application.

    The application's folder may be deleted once the application has ended.
    """
    application = f"siftmine-{spark.sparkContext.applicationId}"
    return f"{shared_folder(spark)}/{application}/{purpose}-{uuid.uuid4().hex}"
