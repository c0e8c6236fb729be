"""Session helpers: time zone pinning and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from contextlib import contextmanager

from pyspark.sql import SparkSession


def recommended_conf(executors: int = 1000, cores_per_executor: int = 4) -> dict[str, str]:
    """Settings for large clusters (pass to the session builder / cluster config).

    Shuffle partitions start at ~3 waves of the cluster's cores; AQE coalesces them to
    ~128 MB each at runtime and splits skewed join partitions (a hot service or series),
    so partitions stay well inside executor memory whatever the day's volume. Scan
    splits of 256 MB keep task counts sane on 100 TB of points.
    """
    cores = executors * cores_per_executor
    return {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(3 * cores),
        "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    }


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "svcvitals", extra: dict | None = None) -> SparkSession:
    """Session for tests and local runs. On a cluster, use the cluster's own session
    and call :func:`configure` on it instead."""
    b = (SparkSession.builder.master(master).appName(app_name)
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.driver.memory", "8g"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Pin what results depend on: all day boundaries are UTC days."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def _checkpoint_root(spark: SparkSession) -> str | None:
    try:
        root = spark.sparkContext.getCheckpointDir()
    except Exception:  # sessions without a SparkContext handle (e.g. Spark Connect)
        root = None
    return root or spark.conf.get("spark.checkpoint.dir", None)


_made: list[str] = []


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` names a folder every executor can reach. It is read from the
    session. Unset, it is an error on a cluster; in local mode, where driver and
    executors are one process, a temporary folder is made and set.
    """
    root = _checkpoint_root(spark)
    if not root:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="svcvitals-ckpt-"))
        root = spark.sparkContext.getCheckpointDir()
    _made.append(f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}")
    return _made[-1]


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give Python workers this package, once per application, as a zip that Spark
    distributes: they need not have it installed."""
    sc = spark.sparkContext
    root = os.path.dirname(os.path.abspath(__file__))
    if sc.applicationId in _shipped or not os.path.isdir(root):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="svcvitals-"), "svcvitals-package.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(root):
            for name in sorted(n for n in names if n.endswith(".py")):
                full = os.path.join(folder, name)
                out.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


@contextmanager
def own_folders(spark: SparkSession):
    """Delete, at the end of the block, the shared folders that were made within it: for a
    job whose DataFrames nobody reads afterwards."""
    before = len(_made)
    try:
        yield
    finally:
        conf = spark._jsparkSession.sessionState().newHadoopConf()
        while len(_made) > before:
            path = spark._jvm.org.apache.hadoop.fs.Path(_made.pop())
            path.getFileSystem(conf).delete(path, True)


__all__ = ["build_session", "configure", "recommended_conf", "shared_dir", "own_folders", "ship_package"]
