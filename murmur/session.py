"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(
    app: str = "murmur", master: str | None = None, conf: dict[str, str] | None = None
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Every bucket (hour, day, weekday) is a UTC bucket."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def check_local(master: str) -> None:
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"set spark.checkpoint.dir to a shared folder; {master} has several machines")


_local_scratch: str | None = None


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for intermediate tables.

    The parent is the folder the cluster names in ``spark.checkpoint.dir``,
    which all executors can reach. Where that setting is absent, a local master
    (tests, local runs) gets a folder of this machine, removed at exit; any other
    master is refused, since each executor would write to its own disk.
    """
    global _local_scratch
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        check_local(spark.conf.get("spark.master", "local"))
        if _local_scratch is None:
            _local_scratch = tempfile.mkdtemp(prefix="murmur-")
            atexit.register(shutil.rmtree, _local_scratch, ignore_errors=True)
        base = _local_scratch
    return f"{base.rstrip('/')}/murmur/{name}-{uuid.uuid4().hex}"
