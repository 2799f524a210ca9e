"""Session helpers.

Operators never build a session; they use the one their input DataFrames
belong to.  ``build_session`` is only for the bench, the tests and small jobs.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def build_session(app: str = "pricelens", master: str | None = None, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # methods over 8 kB are never compiled by the JVM; smaller ones are made then
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
    )
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            builder = builder.config("spark.ui.enabled", "false").config("spark.driver.memory", "12g")
            builder = builder.config("spark.sql.shuffle.partitions", str(os.cpu_count() or 8))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Checkpoint folder of the session.

    A cluster names its shared folder in ``spark.checkpoint.dir``; that setting
    is used as is.  Only where it is unset and the master is local (tests, a
    laptop) a temporary folder takes its place; a cluster without it is an error.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    current = sc.getCheckpointDir()
    if current is None:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="pricelens-checkpoint-"))
        current = sc.getCheckpointDir()
    return current
