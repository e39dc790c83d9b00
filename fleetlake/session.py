"""Session helpers.

``build_session`` is for tests, the bench and local runs only; on a cluster the
caller owns the session and we only read its settings.  ``checkpoint_dir``
returns the shared folder named by ``spark.checkpoint.dir`` and sets a
fallback only when the session has none (local runs).
"""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

#: scratch folders of this process: path -> (session, databases kept there)
_SCRATCH: dict[str, tuple] = {}

LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  driver_memory: str = "16g", extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(master).appName("fleetlake")
    conf = dict(LOCAL_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = driver_memory
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder of this session (set one only when unset)."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 — Spark Connect: no driver context, the server's conf rules
        return spark.conf.get("spark.checkpoint.dir")
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        # one machine's folder serves local runs only: other executors cannot see it
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        conf = tempfile.mkdtemp(prefix="fleetlake-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder; it is removed
    when the driver's Python ends, or before that by ``discard``."""
    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/fleetlake-scratch/{name}-{uuid.uuid4().hex[:12]}"
    if not _SCRATCH:
        atexit.register(_discard_all)
    _SCRATCH[path] = (spark, [])
    return path


def scratch_database(spark: SparkSession, path: str, database: str) -> None:
    """Drop ``database`` together with the scratch folder that holds its tables."""
    _SCRATCH[path][1].append(database)


def discard(path: str) -> None:
    """Remove a scratch folder and its databases; nothing may read them any more."""
    spark, databases = _SCRATCH.pop(path, (None, []))
    if spark is None:
        return
    try:
        for name in databases:
            spark.sql(f"DROP DATABASE IF EXISTS `{name}` CASCADE")
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # noqa: BLE001 — the session is gone: only a local folder can still be removed
        if path.startswith(("/", "file:/")):
            shutil.rmtree(re.sub("^file:/+", "/", path), ignore_errors=True)


def scratch_paths() -> set[str]:
    """The scratch folders that this process has not yet removed."""
    return set(_SCRATCH)


def _discard_all() -> None:
    for path in list(_SCRATCH):
        discard(path)


def tz_utc(spark: SparkSession) -> None:
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


__all__ = ["build_session", "checkpoint_dir", "discard", "scratch_database", "scratch_path", "scratch_paths", "tz_utc"]
