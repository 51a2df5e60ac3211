"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def local_session(cpus: int | str = "*", app_name: str = "textflow", memory: str = "16g") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    partitions = "8" if cpus == "*" else str(cpus)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="textflow-")


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the shared folder that the session names in `spark.checkpoint.dir`.

    Only a local session without that setting gets a folder of its own machine; on a cluster the
    executors could not share one.
    """
    root = spark.conf.get(CHECKPOINT_SETTING, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that all executors share")
        root = _local_root()
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
