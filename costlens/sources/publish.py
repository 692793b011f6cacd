"""Results that replace their predecessor at once, or not at all.

A published folder holds versions, each written in full beside the others, and for
each finished one an empty file whose name has its number. The version with
the highest number is the current one: creating that file is the switch, one atomic step on
file systems and object stores alike, so a reader sees the old version or the
new one, whatever happens to the writing job. Of two jobs at the same time, one stays current
(of equal numbers, the later name). Readers that began with an old version
keep it until ``prune`` deletes it.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

_MARK = "_published-"


def _hadoop(spark: SparkSession, path: str):
    """(Hadoop file system, Path) for any scheme the deployment knows."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _marks(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """(number, version) of the finished versions below ``path``, the current one first."""
    fs, at = _hadoop(spark, f"{path.rstrip('/')}/{_MARK}*")
    names = [status.getPath().getName() for status in fs.globStatus(at) or []]
    found = [name.removeprefix(_MARK).split("-", 1) for name in names]
    return sorted(((int(number), version) for number, version in found), reverse=True)


def versions(spark: SparkSession, path: str) -> list[str]:
    """Names of the published versions below ``path``, the current one first; empty if nothing was published."""
    return [version for _, version in _marks(spark, path)]


def publish(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] | None = None, **options: str
) -> str:
    """Write ``df`` as a new version below ``path`` and make it the current one; returns its folder."""
    spark, name = df.sparkSession, f"v-{uuid.uuid4().hex}"
    folder = f"{path.rstrip('/')}/{name}"
    writer = df.write.format(fmt).options(**options)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(folder)
    number = max((n for n, _ in _marks(spark, path)), default=0) + 1
    fs, mark = _hadoop(spark, f"{path.rstrip('/')}/{_MARK}{number}-{name}")
    fs.create(mark).close()
    return folder


def published(spark: SparkSession, path: str) -> str:
    """The folder of the current version, or ``path`` itself where nothing was published (plain files)."""
    names = versions(spark, path)
    return f"{path.rstrip('/')}/{names[0]}" if names else path


def prune(spark: SparkSession, path: str, keep: int = 1) -> list[str]:
    """Delete all but the newest ``keep`` versions; returns the names of those deleted."""
    if keep < 1:
        raise ValueError("the current version stays")
    old = _marks(spark, path)[keep:]
    for number, version in old:
        for gone in (f"{_MARK}{number}-{version}", version):
            fs, at = _hadoop(spark, f"{path.rstrip('/')}/{gone}")
            fs.delete(at, True)
    return [version for _, version in old]
