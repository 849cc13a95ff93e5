"""A session for one machine. On a cluster the submitter configures the session."""

import os
import tempfile

from pyspark.sql import SparkSession

_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 2 << 20


def local_session(cpus: int | str | None = None) -> SparkSession:
    cpus = cpus or os.environ.get("BENCH_CPUS") or 8
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("foldloom")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.log.level", "ERROR")
        .getOrCreate()
    )


def local_scratch(spark: SparkSession) -> str | None:
    """A folder for intermediate tables of a session on one machine; None on a cluster, which has to name one."""
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        return None
    folder = spark.conf.get("foldloom.scratch", None)
    if not folder:
        folder = tempfile.mkdtemp(prefix="foldloom-")
        spark.conf.set("foldloom.scratch", folder)
    return folder


def bound_batches(spark: SparkSession) -> None:
    """From now on Arrow batches of the session, which the JVM holds twice outside its heap for each task and Python once more, end after
    ``BATCH_BYTES`` and not after 10,000 whole texts or 64 MB. A limit that the session has set itself stays."""
    if _BATCH not in spark.conf.getAll:
        spark.conf.set(_BATCH, str(BATCH_BYTES))
