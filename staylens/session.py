"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings results depend on, applied to any session handed to the library.
REQUIRED_CONF = {
    # Partition directories hold ids such as "0123": never guess their type.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Re-plan on measured shuffle sizes: coalescing, broadcast, skew splits.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a heavy key even where that costs another shuffle further up.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A page can be megabytes of text: keep few of them in one Arrow batch.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "64",
}

# Set where the session says nothing else.
SUGGESTED_CONF = {
    # A heavy key is split as soon as it exceeds one advisory partition (64 MB). Spark's own
    # 256 MB of compressed rows take over a gigabyte once a single task sorts them.
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply :data:`REQUIRED_CONF`, and :data:`SUGGESTED_CONF` where nothing is set, to ``spark`` and return it."""
    for key, value in REQUIRED_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    for key, value in SUGGESTED_CONF.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def local_session(cpus: str | int = "*", app: str = "staylens", **conf: str) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("STAYLENS_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in {**REQUIRED_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    A local session may leave the setting empty and gets a temporary folder;
    on a cluster a machine-local folder would lose data, so that is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="staylens-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/staylens/{name}-{uuid.uuid4().hex}"
