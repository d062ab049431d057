"""Session helpers: shared scratch location and a local session for tests and bench."""

from __future__ import annotations

import atexit
import functools
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(app: str, cores: str | int = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session. On a cluster the job receives its session from spark-submit."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("CASEWRIGHT_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a session that sets no such folder and runs locally gets one of its own, which
    is removed when the process ends.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return _own_folder()


@functools.cache
def _own_folder() -> str:
    folder = tempfile.mkdtemp(prefix="casewright-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def run_folder(spark: SparkSession, purpose: str) -> str:
    """A new, unused folder below the shared one."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"
