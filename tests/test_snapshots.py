import os

import pytest
from pyspark.sql import functions as F

from crawlmeta.operators import geo
from crawlmeta.plans import jobs
from crawlmeta.sinks import snapshots
from crawlmeta.sinks.snapshots import SnapshotTable
from crawlmeta.sources import tsv, warc


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, v long")


def rows(df):
    return sorted((r.k or "", r.v) for r in df.collect())


@pytest.fixture
def table(spark, tmp_path):
    return SnapshotTable(spark, str(tmp_path / "t"), ["k"])


def test_partitions_are_replaced_and_old_versions_stay_readable(spark, table):
    assert table.entry() is None and not snapshots.is_table(spark, table.path)
    assert table.replace(frame(spark, [("a", 1), ("b", 2), (None, 3)])) == 1
    early = table.read()
    assert table.replace(frame(spark, [("a", 10), ("c", 30)]), frame(spark, [("a", 0), (None, 0)])) == 2
    assert rows(table.read()) == [("a", 10), ("b", 2), ("c", 30)]
    assert rows(early) == rows(table.read(1)) == [("", 3), ("a", 1), ("b", 2)]
    table.replace(frame(spark, [("a", 5)]), frame(spark, []))  # rows of a partition that was not announced replace it too
    assert rows(table.read()) == [("a", 5), ("b", 2), ("c", 30)]
    table.replace(frame(spark, []), frame(spark, [("b", 0)]))
    assert rows(snapshots.read(spark, table.path)) == [("a", 5), ("c", 30)]
    table.replace(frame(spark, [("z", 1)]))
    assert rows(table.read()) == [("z", 1)]
    table.replace(frame(spark, []))
    assert rows(table.read()) == [] and table.read().columns == ["k", "v"]


def test_a_run_that_dies_before_its_log_entry_changes_nothing(spark, table, monkeypatch):
    table.replace(frame(spark, [("a", 1)]))
    monkeypatch.setattr(SnapshotTable, "_publish", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        table.replace(frame(spark, [("a", 2), ("b", 2)]))
    monkeypatch.undo()
    assert table.versions() == [1] and rows(table.read()) == [("a", 1)]
    assert len(os.listdir(f"{table.path}/data")) == 2
    assert table.vacuum(older_than_s=3600) == 0
    assert table.vacuum(older_than_s=-5) == 2
    assert len(os.listdir(f"{table.path}/data")) == 1 and rows(table.read()) == [("a", 1)]


def test_of_two_runs_for_one_version_the_later_one_merges_again(spark, table, monkeypatch):
    table.replace(frame(spark, [("a", 1), ("b", 1)]))
    publish, other = SnapshotTable._publish, SnapshotTable(spark, table.path, ["k"])

    def late(self, entry):
        monkeypatch.setattr(SnapshotTable, "_publish", publish)
        other.replace(frame(spark, [("b", 2)]), frame(spark, [("b", 0)]))
        publish(self, entry)

    monkeypatch.setattr(SnapshotTable, "_publish", late)
    assert table.replace(frame(spark, [("a", 3)]), frame(spark, [("a", 0)])) == 3
    assert rows(table.read()) == [("a", 3), ("b", 2)] and rows(table.read(2)) == [("a", 1), ("b", 2)]
    assert [n for n in os.listdir(f"{table.path}/log") if n.startswith("_")] == []


def test_unchanged_commits_are_read_without_a_join(spark, table):
    table.replace(frame(spark, [("a", 1)]))
    table.replace(frame(spark, [("b", 1)]), frame(spark, []))
    assert "Join" not in table.read()._jdf.queryExecution().executedPlan().toString()
    table.replace(frame(spark, [("b", 2)]), frame(spark, [("b", 0)]))
    assert "Join" not in table.read()._jdf.queryExecution().executedPlan().toString()  # a commit without live partitions is gone
    table.replace(frame(spark, [("c", 1), ("d", 1)]), frame(spark, []))
    table.replace(frame(spark, [("c", 2)]), frame(spark, [("c", 0)]))
    plan = table.read()._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "dynamicpruning" in plan.lower()


def test_several_keys_and_text(spark, tmp_path):
    t = SnapshotTable(spark, str(tmp_path / "t"), ["g", "k"], "text")
    made = spark.createDataFrame([("x", "1", "one"), ("x", "2", "two"), ("y", "1", "three")], "g string, k string, value string")
    t.replace(made)
    t.replace(made.where("g = 'x' AND k = '2'").withColumn("value", F.lit("new")), made.where("k = '2'").select("g", "k"))
    assert sorted(r.value for r in snapshots.read(spark, t.path).collect()) == ["new", "one", "three"]
    assert {r.value for r in tsv.read_lines(spark, t.path).collect()} == {"new", "one", "three"}


def test_jobs_write_snapshot_tables(spark, tmp_path):
    src, links, table, groups = (str(tmp_path / n) for n in ("in", "links", "table", "groups"))
    os.mkdir(src)

    def archive(name, body):
        with open(f"{src}/{name}.warc.gz", "wb") as f:
            f.write(warc.warc_bytes([(f"https://{name}.example.ua/robots.txt", "2024-08-01T00:00:00Z", body, "")]))

    archive("a", b"Sitemap: /a.xml\n")
    archive("b", b"Sitemap: /b.xml\n")
    for run in (1, 2):
        before = snapshots.read(spark, links) if run == 2 else None
        jobs.sitemaps_job(spark, src, links, snapshots=True)
        jobs.robots_job(spark, src, table, str(tmp_path / "files"), snapshots=True)
        archive("a", b"<html>")
    assert before.count() == 2  # still the rows of the first run
    assert [r.value.split("\t")[3] for r in snapshots.read(spark, links).collect()] == ["/b.xml"]
    assert [r.target_url for r in snapshots.read(spark, table).collect()] == ["https://b.example.ua/robots.txt"]
    lines = tmp_path / "tsv"
    lines.mkdir()
    (lines / "x.sitemaps.tsv").write_text("f\texample.ua\thttps\thttps://example.ua/ru/s.xml\nbad\n")
    res = jobs.filter_sitemaps_job(spark, str(lines), groups, geo.sample_dimension(spark), snapshots=True)
    assert res.metrics == {"read_rows": 1, "malformed_rows": 1, "kept_rows": 1}
    assert sorted(r.out_group for r in snapshots.read(spark, groups).collect()) == ["country", "language-region"]
