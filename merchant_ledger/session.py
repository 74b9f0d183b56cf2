"""Session settings for local runs, and the shared folder for cut lineage."""

from __future__ import annotations

import os
import re
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", memory: str = "8g") -> SparkSession:
    """A session for tests and benchmarks. On a cluster, bring your own."""
    partitions = os.cpu_count() if cpus == "*" else int(cpus)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("merchant_ledger")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name below the folder that all executors share.

    That is the one in ``spark.checkpoint.dir``. Where it is unset, a session of one machine
    takes the warehouse; on a cluster, whose warehouse may be a folder of the driver's own,
    that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = spark.conf.get("spark.sql.warehouse.dir")
    folder = f"{root.rstrip('/')}/merchant-ledger/{spark.sparkContext.applicationId}/{purpose}"
    return f"{folder}-{uuid.uuid4().hex}"


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder of a shared file system, if it is there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def clean_up(spark: SparkSession) -> None:
    """Remove all that this application has written to shared folders.

    Frames that read from there can't be used any more; the ledger of a replay goes too.
    """
    delete(spark, os.path.dirname(shared_folder(spark, "any")))
