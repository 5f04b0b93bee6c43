"""Session construction and the shared work folder.

On a cluster the operator names the shared folder through
``spark.checkpoint.dir``; we only read it. A private folder is created only
when nothing is configured (local tests), never on a configured cluster.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Runtime (AQE) broadcast only below a measured shuffle size.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The files a scan opens are named by the manifest: look a few hundred up in place, no listing job.
    "spark.sql.sources.parallelPartitionDiscovery.threshold": "512",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "pricepanel", extra: dict | None = None) -> SparkSession:
    """A session with the engine defaults; ``extra`` overrides any key."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def _configured_checkpoint_dir(spark: SparkSession) -> str | None:
    value = spark.conf.get("spark.checkpoint.dir", None)
    if value:
        return value
    try:
        return spark.sparkContext.getCheckpointDir()
    except Exception:  # Spark Connect has no SparkContext
        return None


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    Only a local-mode session (tests, a laptop) without that setting gets a
    private folder; on a cluster a machine-local folder would not be seen
    by executors or survive their loss, so it is an error.
    """
    root = _configured_checkpoint_dir(spark)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/object store) for this cluster")
    root = tempfile.mkdtemp(prefix="pricepanel-ckpt-")
    spark.conf.set("spark.checkpoint.dir", root)
    try:
        spark.sparkContext.setCheckpointDir(root)
    except Exception:
        pass
    return root


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared root for one job's output.

    Whoever writes makes it: a path without a scheme belongs to the cluster's
    default file system, not to the driver's disk.
    """
    return f"{checkpoint_root(spark)}/pricepanel/{name}-{uuid.uuid4().hex[:12]}"


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``pricepanel`` importable in Python workers (``addPyFile``).

    Only the archive readers and packers run Python inside tasks; their
    functions refer to this package, so executors need its code. The zip
    is built once per driver process and shipped once per application.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    base = os.path.dirname(pkg)
    path = os.path.join(tempfile.mkdtemp(prefix="pricepanel-pyfiles-"), "pricepanel.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(pkg):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, base))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)
