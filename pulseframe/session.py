"""Session helpers: a local session for tests and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", **conf: str) -> SparkSession:
    """Session for tests and the benchmark; on a cluster use the one you are given."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("pulseframe")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder that all executors see, named by ``spark.checkpoint.dir``.

    A temporary folder is used only where the setting is missing and the
    session is a local one; on a cluster a missing setting is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return os.path.join(tempfile.gettempdir(), "pulseframe-shared")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other job uses."""
    return f"{shared_dir(spark)}/pulseframe/{name}-{uuid.uuid4().hex}"
