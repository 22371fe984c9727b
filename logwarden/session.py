"""Session settings used by jobs, tests and the bench."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession


def session(app: str = "logwarden", master: str | None = None, **conf: str) -> SparkSession:
    """A session pinned to UTC with adaptive execution; ``conf`` overrides any setting."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that ``spark.checkpoint.dir`` names.

    Only a session in one process may do without the setting; it gets a temporary folder.  On a cluster the executors
    would write to their own disks, so a missing setting is an error there.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="logwarden-")
        spark.conf.set("spark.checkpoint.dir", folder)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder
