"""Session construction and shared scratch locations."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every cartwright job relies on.  AQE coalesces the small shuffles
# of report-sized aggregates and splits skewed join partitions at run time.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str = "local[*]",
    shuffle_partitions: int = 8,
    app_name: str = "cartwright",
    extra_conf: dict | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the defaults above.

    On a cluster, pass ``master=None`` so spark-submit decides, and size
    ``shuffle_partitions`` to the data (AQE coalesces downward from it).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session first.  Only a local-mode session (tests, this
    container) may fall back to a fresh temporary folder; on a cluster a
    machine-local folder would be invisible to the other executors, so a
    missing setting is an error there.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        # local-cluster has executors of their own, as a cluster does
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError(
                "spark.checkpoint.dir is unset; point it at a shared folder"
            )
        root = tempfile.mkdtemp(prefix="cartwright-ckpt-")
    if not sc.getCheckpointDir():
        # DataFrame.checkpoint() needs the context's directory as well.
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused path under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"
