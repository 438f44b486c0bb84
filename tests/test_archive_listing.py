"""Tables with a folder per archive are listed by a bounded number of tasks."""

from __future__ import annotations

from pyspark.sql import functions as F

from crawlmeta.session import dealt_listing
from crawlmeta.sinks import robots_files

LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def test_folders_of_archives_share_listing_tasks(spark, tmp_path):
    archives = 40 * spark.sparkContext.defaultParallelism
    out = str(tmp_path / "out")
    rows = spark.range(archives).select(F.concat(F.lit("a"), "id").alias("archive_path"), F.col("id").cast("string").alias("value"))
    robots_files.write_by_archive(rows, out, rows.groupBy("archive_path").agg(F.count(F.lit(1)).alias("rows")))
    before, tracker = spark.conf.get(LISTING), spark.sparkContext.statusTracker()
    group = "listing-of-archives"
    spark.sparkContext.setJobGroup(group, group)
    try:
        found = robots_files.read_by_archive(spark, out)
        stages = [s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
        tasks = [i.numTasks for i in map(tracker.getStageInfo, stages) if i]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert tasks and max(tasks) <= 4 * spark.sparkContext.defaultParallelism
    assert spark.conf.get(LISTING) == before
    assert sorted(r["value"] for r in found.collect()) == sorted(map(str, range(archives)))


def test_listing_setting_is_put_back(spark):
    before = spark.conf.get(LISTING)
    try:
        with dealt_listing(spark):
            assert int(spark.conf.get(LISTING)) <= 4 * spark.sparkContext.defaultParallelism
            raise ValueError
    except ValueError:
        pass
    assert spark.conf.get(LISTING) == before
