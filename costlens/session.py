"""Session helpers for tests, the bench and local runs.

On a cluster the session comes from the deployment; the library only reads
settings from it. ``scratch_dir`` is the one place that writes files outside
an explicit output path, and it always lives under the shared
``spark.checkpoint.dir``.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(
    master: str = "local[8]",
    shuffle_partitions: int = 8,
    app_name: str = "costlens",
    driver_memory: str = "8g",
) -> SparkSession:
    """A session configured the way the tests and the bench expect."""
    return (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # List folder trees of many small files with a distributed job once
        # there are more than a few root folders (run trees: one per day), in
        # a few tasks per core rather than one task per path.
        .config("spark.sql.sources.parallelPartitionDiscovery.threshold", "8")
        .config("spark.sql.sources.parallelPartitionDiscovery.parallelism", str(4 * shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Long sessions run many short queries: keep little history in the
        # driver's status store (plan graphs, job and stage records).
        .config("spark.sql.ui.retainedExecutions", "20")
        .config("spark.ui.retainedJobs", "100")
        .config("spark.ui.retainedStages", "100")
        .config("spark.driver.memory", driver_memory)
        .getOrCreate()
    )


def read_tasks(spark: SparkSession) -> int:
    """Tasks for a read of many small files: a few per core, and no fewer than an exchange has."""
    return max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """The session's SQL settings changed to ``values`` for the code within, then as they were."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


class CheckpointDirError(RuntimeError):
    """No shared checkpoint folder is configured on a cluster."""


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    Read from the running context or from ``spark.checkpoint.dir``. Only a
    local-mode session (tests) falls back to a fresh temporary folder; on a
    cluster a machine-local folder would not be shared, so it is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise CheckpointDirError(
                "set spark.checkpoint.dir to a shared folder (HDFS, object store)"
            )
        configured = tempfile.mkdtemp(prefix="costlens-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/costlens-{label}-{uuid.uuid4().hex}"
