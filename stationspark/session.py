"""Session helpers.

Library functions never create or stop a session: the caller owns it.
``build_session`` is for tests, the bench and command-line use only.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale; every one of them is a plain Spark option.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    # Adaptive execution: coalesce small shuffle partitions, split skewed
    # join partitions, switch a join to broadcast from runtime statistics.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Dirty metric text is cleaned with try_cast, so ANSI mode stays on.
    "spark.sql.ansi.enabled": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "stationspark", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder for written intermediate tables, shared by driver and executors.

    ``spark.checkpoint.dir`` where the session names one (on a cluster it
    must).  Where it is unset in a local session, a folder below the
    warehouse; elsewhere that may be each machine's own, so it is an error.
    The setting is only ever read: Spark refuses to change it at run time.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that driver and executors share")
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared folder."""
    return f"{shared_dir(spark)}/stationspark/{name}-{uuid.uuid4().hex}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for plain-Python file access in tests."""
    return path[len("file:"):] if path.startswith("file:") else path


__all__ = ["build_session", "shared_dir", "scratch_path", "local_path"]
