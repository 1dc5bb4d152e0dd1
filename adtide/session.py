"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def local_session(app: str, cores: int | str = "*", memory: str = "8g") -> SparkSession:
    """Session for tests and the benchmark. A cluster brings its own settings."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: the one the cluster names, else one in its warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work"


def new_workspace(spark: SparkSession, purpose: str) -> str:
    """A fresh, unused folder name below the shared folder, grouped by application.

    The folder of an application can be deleted once it has ended.
    """
    application = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/{application}/{purpose}-{uuid.uuid4().hex}"
