"""Spark session helpers.

The library never creates a session implicitly inside an operator; callers pass
one in.  ``get_session`` is for tests, the bench and the CLI entry points.  It
turns on the settings every job here relies on:

* adaptive query execution with partition coalescing and skew-join splitting,
  and run-time broadcast conversion bounded by an explicit byte threshold (the
  only broadcasts of data-derived tables are the ones AQE proves small at run
  time from the materialised shuffle statistics);
* UTC session time zone (match timestamps carry no zone);
* no web UI.

``checkpoint_dir`` reads ``spark.checkpoint.dir`` from the session.  Only when
it is unset (local tests) does it fall back to a fresh scratch directory.
"""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

# Run-time broadcast limit for data-derived join sides (bytes).
AQE_BROADCAST_BYTES = 64 * 1024 * 1024


def get_session(master: str | None = None, shuffle_partitions: int = 8,
                app_name: str = "matchmart") -> SparkSession:
    master = master or os.environ.get("MATCHMART_MASTER", "local[8]")
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold",
                str(AQE_BROADCAST_BYTES))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # the many short jobs of the booster wait 40 ms each on a TCP acknowledgement otherwise
        .config("spark.python.unix.domain.socket.enabled", "true")
        .config("spark.driver.memory", os.environ.get("MATCHMART_DRIVER_MEM", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint directory.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is.  Only when it is unset (local tests) a scratch directory is created and
    registered, so ``DataFrame.checkpoint()`` works.
    """
    sc = spark.sparkContext
    registered = sc.getCheckpointDir()
    if registered:
        return registered
    current = sc.getConf().get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="matchmart-ckpt-")
    sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh directory under the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark)
    path = os.path.join(base, f"{name}-{os.urandom(6).hex()}")
    return path


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the session's Python workers, once per application.

    Spark's own file server carries the archive, so workers need neither the
    repository nor a shared folder.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(package)
    archive = os.path.join(tempfile.mkdtemp(prefix="matchmart-py-"), "matchmart_py.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, root))
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(app)
