"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", memory: str = "20g", **config: str) -> SparkSession:
    """Session for tests and the local benchmark. On a cluster, pass your own session instead.

    The test files hold one row group each, so a scan is one task. Broadcasting only tiny tables
    makes joins shuffle and gives the work after them to all cores.
    """
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("lakeops")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.autoBroadcastJoinThreshold", "256k")
    )
    for key, value in config.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_own: dict[str, str] = {}


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the folder the cluster shares through ``spark.checkpoint.dir``.

    Only a local master may do without: it gets one temporary folder for the process. On a cluster
    the executors would not see that. The session's settings stay as they are.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        if master not in _own:
            _own[master] = tempfile.mkdtemp(prefix="lakeops-")
        base = _own[master]
    return f"{base.rstrip('/')}/lakeops/{label}-{uuid.uuid4().hex}"
