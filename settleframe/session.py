"""Session helpers.

The library never builds a session for a caller: every entry point takes the
caller's ``SparkSession``. ``local_session`` exists for tests and the bench.
``work_dir`` resolves the shared folder used for checkpoints and scratch
tables: it is read from the session (``spark.checkpoint.dir``); only a local
master may fall back to a fresh folder under the system temp directory.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Session settings that matter for correctness of the results.
# UTC keeps timestamp <-> date conversions independent of the host.
_SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "settleframe", extra: dict | None = None) -> SparkSession:
    """Session for tests and benchmarks (local mode only)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app_name)
    conf = dict(_SESSION_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = "8g"
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def work_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and scratch tables.

    Order: the context's checkpoint dir, then ``spark.checkpoint.dir`` from the
    session conf. If neither is set, a local master gets a fresh temp folder
    (as in tests); a cluster master raises, because a machine-local folder is
    not visible to other executors and does not survive their loss.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder "
                "(HDFS/object store) visible to every executor")
        configured = tempfile.mkdtemp(prefix="settleframe-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


_SCRATCH: dict[str, set[str]] = {}


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never-reused path under the shared work folder. What is written
    there stays until ``clean_scratch``: lazy results may still read it."""
    path = f"{work_dir(spark).rstrip('/')}/settleframe/{label}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.setdefault(spark.sparkContext.applicationId, set()).add(path)
    return path


def clean_scratch(spark: SparkSession) -> int:
    """Delete the scratch folders this process made in the running application,
    once their results are no longer read. Returns how many."""
    from settleframe.sources.files import delete

    paths = _SCRATCH.pop(spark.sparkContext.applicationId, set())
    for path in paths:
        delete(spark, path)
    return len(paths)
