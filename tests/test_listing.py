import time

import pytest
from test_export import FULL_MD, manifest, put

from costlens.session import read_tasks, settings
from costlens.sources.runs import manifests, read_run_tree

DISCOVERY = "spark.sql.sources.parallelPartitionDiscovery"
#: What a session has that sets nothing about listing.
PLAIN = {f"{DISCOVERY}.threshold": "32", f"{DISCOVERY}.parallelism": "10000", "spark.sql.sources.ignoreDataLocality": "false"}


def job_tasks(spark, group):
    """Tasks of each stage of the group's jobs."""
    tracker, last = spark.sparkContext.statusTracker(), None
    for _ in range(50):  # what the tracker knows comes a little later than the jobs end
        jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(group)]
        found = [tracker.getStageInfo(s) for j in jobs if j for s in j.stageIds]
        now = sorted(s.numTasks for s in found if s)
        if now and now == last:
            return now
        last = now
        time.sleep(0.2)
    return last


@pytest.fixture(scope="module")
def wide_root(tmp_path_factory):
    root = tmp_path_factory.mktemp("wide")
    for i in range(150):
        put(root, f"runs/2026-04-0{1 + i % 2}/r{i}/manifest.json", manifest(4, "g5.xlarge", "ami-a", 1))
    put(root, "runs/2026-04-01/r0/output/md_benchmark.out", FULL_MD)
    return str(root)


def test_a_listing_takes_few_tasks_however_many_runs(spark, wide_root):
    with settings(spark, PLAIN):
        spark.sparkContext.setJobGroup("listing", "listing")
        try:
            tree = read_run_tree(spark, wide_root)
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert {k: spark.conf.get(k) for k in PLAIN} == PLAIN
        tasks = job_tasks(spark, "listing")
        assert tasks and max(tasks) <= read_tasks(spark) < 75  # one a folder before
        assert tree.count() == 151 and manifests(tree).count() == 150


def test_a_read_takes_few_tasks_however_many_files(spark, wide_root):
    with settings(spark, {"spark.sql.files.openCostInBytes": "128m"}):  # one file a split
        assert read_run_tree(spark, wide_root).rdd.getNumPartitions() == read_tasks(spark)


def test_settings_are_put_back(spark):
    key = f"{DISCOVERY}.parallelism"
    was = spark.conf.get(key, None)
    spark.conf.unset("spark.sql.sources.ignoreDataLocality")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_run_tree(spark, "/nowhere/at/all", "2026-04-01")
    assert spark.conf.get(key, None) == was and spark.conf.get("spark.sql.sources.ignoreDataLocality", None) is None
