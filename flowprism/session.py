"""Session helpers.

Library code never builds its own session: it takes the caller's.  ``build_session`` is for tests,
the bench and local runs.  ``checkpoint_dir`` reads ``spark.checkpoint.dir`` from the session and
only sets a scratch directory when the cluster did not name one (local tests).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def build_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "flowprism") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.scheduler.mode", "FAIR")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("FLOWPRISM_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster; a scratch folder only when unset (local sessions of ``build_session``)."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = tempfile.mkdtemp(prefix="flowprism-ckpt-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path
