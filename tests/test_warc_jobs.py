import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from crawlmeta.operators import crawl as crawl_op
from crawlmeta.operators import geo
from crawlmeta.plans import jobs
from crawlmeta.sources import warc


def _archive(path, rows):
    with open(path, "wb") as f:
        f.write(warc.warc_bytes(rows))


ROBOTS = b"User-agent: *\nDisallow: /x\nSitemap: https://example.ua/uk/sitemap.xml\nSitemap: /s.xml\n"


def test_warc_source_decodes_stacked_encodings_and_skips_noise(spark, tmp_path):
    _archive(tmp_path / "a.warc.gz", [
        ("https://example.ua/robots.txt", "2024-08-01T00:00:00.500Z", ROBOTS, "deflate, gzip"),
        ("https://example.de/ROBOTS.TXT", "2024-08-01T00:00:01Z", b"<html>", "gzip"),
        ("https://example.ua/not-robots.txt", "2024-08-01T00:00:02Z", ROBOTS, ""),
    ])
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(b"garbage\r\n\r\n"))
    rows = warc.read_warc(spark, str(tmp_path)).orderBy("archive_path", "target_url").collect()
    ok = [r for r in rows if r["error"] is None]
    assert [(r["target_url"], r["capture_date"], bytes(r["body"])) for r in ok] == [
        ("https://example.de/ROBOTS.TXT", "2024-08-01T00:00:01Z", b"<html>"),
        ("https://example.ua/robots.txt", "2024-08-01T00:00:00.500Z", ROBOTS)]
    bad = [r for r in rows if r["error"] is not None]
    assert len(bad) == 1 and bad[0]["archive_path"].endswith("b.warc.gz")


def test_undecodable_body_is_a_row_error(spark, tmp_path):
    p = tmp_path / "c.warc.gz"
    rec = warc._record([("WARC-Type", "response"), ("WARC-Target-URI", "https://x/robots.txt"),
                        ("WARC-Date", "2024-01-01T00:00:00Z")],
                       b"HTTP/1.1 200 OK\r\nContent-Encoding: gzip\r\n\r\nnot gzip")
    p.write_bytes(rec)
    r = warc.read_warc(spark, str(p)).first()
    assert r["body"] is None and r["error"].startswith("Body decode failed")


def test_sitemaps_and_country_jobs(spark, tmp_path):
    _archive(tmp_path / "in" / "x.warc.gz" if (tmp_path / "in").mkdir() is None else None, [
        ("https://example.ua/robots.txt", "2024-08-01T00:00:00Z", ROBOTS, "gzip"),
        ("https://example.de/robots.txt", "2024-08-01T00:00:00Z", b"Sitemap: https://cdn.example.ua/s.xml\n", ""),
        ("https://example.fr/robots.txt", "2024-08-01T00:00:00Z", b"<html>", "")])
    res = jobs.sitemaps_job(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert res.metrics == {"parsed_files": 2, "rejected_files": 1, "sitemap_links": 3}
    per = res.per_unit.collect()
    assert [(r["parsed_files"], r["rejected_files"], r["sitemap_links"]) for r in per] == [(2, 1, 3)]
    lines = spark.read.text(str(tmp_path / "out")).collect()
    assert len(lines) == 3 and all(len(r["value"].split("\t")) == 4 for r in lines)
    dim = geo.sample_dimension(spark)
    res = jobs.country_sitemaps_job(spark, str(tmp_path / "in"), str(tmp_path / "ua"), "ukraine", dim)
    got = sorted(r["value"].split("\t")[3] for r in spark.read.text(str(tmp_path / "ua")).collect())
    assert got == ["/s.xml", "https://cdn.example.ua/s.xml", "https://example.ua/uk/sitemap.xml"]
    with pytest.raises(ValueError, match="Unknown sitemap country 'russia'"):
        jobs.country_sitemaps_job(spark, str(tmp_path / "in"), str(tmp_path / "ru"), "russia", dim)


def test_robots_job_writes_table_and_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    _archive(tmp_path / "in" / "x.warc.gz", [("https://Example.UA/robots.txt", "2024-08-01T00:00:00Z", ROBOTS, ""),
                                             ("https://example.fr/robots.txt", "2024-08-01T00:00:00Z", b"<x>", "")])
    res = jobs.robots_job(spark, str(tmp_path / "in"), str(tmp_path / "table"), str(tmp_path / "files"))
    assert res.metrics == {"saved_files": 1, "rejected_files": 1}
    (name,) = [r["file_name"] for r in spark.read.parquet(str(tmp_path / "table")).collect()]
    assert name.startswith("example.ua/https-2024-08-01T00_00_00Z-") and name.endswith(".txt")
    assert (tmp_path / "files" / name).read_bytes() == ROBOTS


def test_local_filter_download_publish_chain(spark, tmp_path):
    tree = tmp_path / "robots" / "example.ua"
    tree.mkdir(parents=True)
    (tree / "HTTPS-2024-x.txt").write_bytes(b"User-agent: *\nSitemap: https://example.ua/sitemap.xml\n"
                                            b"Sitemap: file:///not/usable.xml\n")
    (tree / "bad.txt").write_bytes(b"<html>")
    res = jobs.local_sitemaps_job(spark, str(tmp_path / "robots"), str(tmp_path / "local"))
    assert res.metrics == {"parsed_files": 1, "rejected_files": 1}
    (line,) = [r["value"] for r in spark.read.text(str(tmp_path / "local")).collect()]
    f = line.split("\t")
    assert f[1:] == ["example.ua", "https", "https://example.ua/sitemap.xml"] and f[0].endswith("HTTPS-2024-x.txt")
    # the download step reads bodies from a table of fetched documents
    docs = spark.createDataFrame([
        ("https://example.ua/sitemap.xml", "<sitemapindex><sitemap><loc>/urls.txt</loc></sitemap></sitemapindex>"),
        ("https://example.ua/urls.txt", "https://example.ua/uk/a\nhttps://example.ua/b\n")], "url string, body string")
    src = tmp_path / "tsv"
    src.mkdir()
    seed_line = "\t".join(f[:3] + ["https://example.ua/missing.xml"])
    (src / "part-00000.sitemaps.tsv").write_text(line + "\n" + seed_line + "\nmalformed row\n")
    dim = geo.sample_dimension(spark)
    res = jobs.filter_sitemaps_job(spark, str(src), str(tmp_path / "grouped"), dim)
    assert res.metrics == {"read_rows": 2, "malformed_rows": 1, "kept_rows": 2}
    g = spark.read.text(str(tmp_path / "grouped")).select("out_group", "out_key").collect()
    assert sorted((r["out_group"], r["out_key"]) for r in g) == [
        ("country", "ukraine"), ("country", "ukraine"), ("language-region", "unknown"), ("language-region", "unknown")]
    res = jobs.download_sitemaps_job(spark, str(src), str(tmp_path / "links"),
                                     fetcher=crawl_op.table_fetcher(docs))
    assert (res.metrics["downloaded_sitemaps"], res.metrics["failed_downloads"], res.metrics["saved_links"],
            res.metrics["malformed_rows"]) == (2, 1, 2, 1)
    links = tmp_path / "links2"
    links.mkdir()
    rows = sorted(r["value"] for r in spark.read.text(str(tmp_path / "links")).collect())
    (links / "part-00000.sitemap-links.tsv").write_text("\n".join(rows) + "\nshort\trow\n")
    res = jobs.publish_urls_job(spark, str(links), str(tmp_path / "json"))
    assert res.metrics["sent_urls"] == 2 and res.metrics["malformed_rows"] == 1 and res.metrics["files"] == 1
    vals = sorted(json.loads(r["value"])["url"] for r in spark.read.text(str(tmp_path / "json")).collect())
    assert vals == ["https://example.ua/b", "https://example.ua/uk/a"]


def test_option_checks():
    with pytest.raises(ValueError):
        jobs.FetchPolicy(connect_timeout_s=0)
    with pytest.raises(ValueError):
        jobs.FetchPolicy(delay_s=-1)
    with pytest.raises(ValueError):
        jobs._check_slice(-1, None)
    with pytest.raises(ValueError):
        jobs._check_slice(0, 0)


def test_manifest_stage(spark, tmp_path):
    (tmp_path / "crawl-data" / "robotstxt").mkdir(parents=True)
    arch = tmp_path / "crawl-data" / "robotstxt" / "a.warc.gz"
    _archive(arch, [("https://example.ua/robots.txt", "2024-08-01T00:00:00Z", ROBOTS, "")])
    man = tmp_path / "robotstxt.paths.gz"
    man.write_bytes(gzip.compress(f"# c\n\n{arch.as_uri()}\n{arch.as_uri()}x\nother/wat/b.warc.gz\n".encode()))
    staged = jobs.stage_archives(spark, str(man), str(tmp_path / "staged"))
    ((path, archive),) = warc.staged_paths(staged.path_table)
    assert archive == arch.as_uri() and os.path.exists(path) and staged.failed.count() == 0


def test_manifest_job_keeps_names_and_goes_on_after_a_failed_fetch(spark, tmp_path):
    (tmp_path / "robotstxt").mkdir()
    arch = tmp_path / "robotstxt" / "a,b.warc.gz"
    _archive(arch, [("https://t.test/robots.txt", "2024-08-01T00:00:00Z", b"Sitemap: /one.xml\n", "gzip")])
    gone = tmp_path / "robotstxt" / "gone.warc.gz"
    man = tmp_path / "robotstxt.paths.gz"
    man.write_bytes(gzip.compress(f"{arch.as_uri()}\n{gone.as_uri()}\n".encode()))
    staged = jobs.stage_archives(spark, str(man), str(tmp_path / "staged"))
    out = str(tmp_path / "out")
    with pytest.raises(jobs.JobFailed, match="1 archives or captures failed, listed in .*out-failures"):
        jobs.sitemaps_job(spark, staged, out)
    (line,) = [r["value"] for r in spark.read.text(out).collect()]
    assert line.split("\t") == [arch.as_uri(), "2024-08-01T00:00:00Z", "https://t.test/robots.txt", "/one.xml"]
    (listed,) = [r["value"] for r in spark.read.text(out + "-failures").collect()]
    assert listed.startswith(f"{gone.as_uri()}: archive: FileNotFoundError")


def test_second_runs_replace_what_they_process(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    for name, body in (("a", b"Sitemap: /a.xml\n"), ("b", b"Sitemap: /b.xml\n")):
        _archive(src / f"{name}.warc.gz", [(f"https://{name}.test/robots.txt", "2024-08-01T00:00:00Z", body, "")])
    links, table = str(tmp_path / "links"), str(tmp_path / "table")
    one = lambda name: str(src / f"{name}.warc.gz")
    for name in "ab":
        jobs.sitemaps_job(spark, one(name), links)
        jobs.robots_job(spark, one(name), table)
    assert spark.read.text(links).count() == 2 and spark.read.parquet(table).count() == 2
    _archive(src / "a.warc.gz", [("https://a.test/robots.txt", "2024-08-01T00:00:00Z", b"<html>", "")])
    jobs.sitemaps_job(spark, one("a"), links)
    jobs.robots_job(spark, one("a"), table)
    assert [r["value"].split("\t")[3] for r in spark.read.text(links).collect()] == ["/b.xml"]
    assert [r["target_url"] for r in spark.read.parquet(table).collect()] == ["https://b.test/robots.txt"]


def test_every_failure_is_listed(spark, tmp_path):
    rec = b"".join(warc._record([("WARC-Type", "response"), ("WARC-Target-URI", f"https://t{i}.test/robots.txt"),
                                 ("WARC-Date", "2024-01-01T00:00:00Z")], b"HTTP/1.1 200 OK\r\nContent-Encoding: gzip\r\n\r\nno")
                   for i in range(1500))
    (tmp_path / "c.warc.gz").write_bytes(rec)
    with pytest.raises(jobs.JobFailed, match="^1500 "):
        jobs.sitemaps_job(spark, str(tmp_path / "c.warc.gz"), str(tmp_path / "out"))
    assert spark.read.text(str(tmp_path / "out-failures")).distinct().count() == 1500


def test_large_records_and_message_framing(spark, tmp_path):
    big = b"# " + b"x" * (70 << 20) + b"\nSitemap: /big.xml\n"
    def record(url, head, body):
        return warc._record([("WARC-Type", "response"), ("WARC-Target-URI", url), ("WARC-Date", "2024-01-01T00:00:00Z")],
                            b"HTTP/1.1 200 OK\r\n" + head + b"\r\n" + body)
    chunked = b"5;x=y\r\nSitem\r\n9\r\nap: /c.xm\r\n1\r\nl\r\n0\r\n\r\n"
    (tmp_path / "d.warc.gz").write_bytes(
        record("https://a.test/robots.txt", b"", big) + record("https://a.test/page", b"", big)
        + record("https://b.test/robots.txt", b"Transfer-Encoding: chunked\r\n", chunked)
        + record("https://c.test/robots.txt", b"Transfer-Encoding: chunked\r\n", b"Sitemap: /joined.xml")
        + record("https://d.test/robots.txt", b"Content-Length: 15\r\n", b"Sitemap: /e.xml\n\n trailer"))
    got = {r["target_url"][8]: r for r in warc.read_warc(spark, str(tmp_path)).selectExpr(
        "target_url", "length(body) as n", "substr(body, 1, 100) as head", "error").collect()}
    assert got["a"]["n"] == len(big) and got["a"]["error"] is None
    assert [bytes(got[k]["head"]) for k in "bcd"] == [b"Sitemap: /c.xml", b"Sitemap: /joined.xml", b"Sitemap: /e.xml"]


def test_fetch_uses_the_configured_tasks(spark):
    from crawlmeta.sources import fetch
    urls = spark.range(200_000).selectExpr("concat('none://h', id % 5000, '.test/', id) as url")
    got = fetch.fetch(urls, delay=0, partitions=64).selectExpr("spark_partition_id() as p", "error").groupBy("p").count()
    assert got.count() == 64


def test_any_failed_request_is_an_attempt(monkeypatch):
    import http.client

    from crawlmeta.sources import fetch
    monkeypatch.setattr(fetch.time, "sleep", lambda s: None)
    seen = []
    def broken(url, connect, read):
        seen.append((connect, read))
        raise http.client.IncompleteRead(b"x") if len(seen) % 2 else http.client.InvalidURL("bad")
    monkeypatch.setattr(fetch, "_open_url", broken)
    url, status, body, attempts, error = fetch.fetch_one("https://t.test/a b", connect_timeout=3, read_timeout=7, delay=0)
    assert (status, body, attempts) == (None, None, 4) and "InvalidURL" in error and set(seen) == {(3, 7)}


def test_file_fetch(spark, tmp_path):
    from crawlmeta.sources import fetch
    p = tmp_path / "x.xml"
    p.write_bytes(b"abc")
    urls = spark.createDataFrame([(p.as_uri(),), ("ftp://x/y",), (str(p),)], "url string")
    got = {r["url"]: (r["body"], r["error"]) for r in fetch.fetch(urls, delay=0).collect()}
    assert bytes(got[p.as_uri()][0]) == b"abc"
    assert got["ftp://x/y"] == (None, "Unsupported URI scheme: ftp")
    assert got[str(p)][0] is None


def test_urls_that_ask_no_host_share_no_task(spark):
    from crawlmeta.sources import fetch
    urls = spark.range(4_000).selectExpr("concat('gopher://x/', id) as url")
    got = fetch.fetch(urls, delay=0, partitions=16).selectExpr("spark_partition_id() as p", "attempts").groupBy("p").count().collect()
    assert len(got) == 16 and max(r["count"] for r in got) < 500
    per_host = fetch.fetch(urls.selectExpr("replace(url, 'gopher', 'https') as url"), delay=0, partitions=16)
    assert "pmod(xxhash64(url" in per_host._jdf.queryExecution().optimizedPlan().toString() and not list(fetch._batches(iter([])))
    sizes = [len(x) for x in fetch._batches(iter([("u", 200, b"x" * n, 1, None) for n in [5] * 600 + [fetch.BATCH_BYTES, 1]]))]
    assert sizes == [256, 256, 89, 1]


def test_exported_files_are_spread_over_tasks(spark, tmp_path):
    from crawlmeta.sinks import robots_files
    rows = spark.range(0, 400, 1, 1).selectExpr("concat(id, '.txt') as file_name", "concat(spark_partition_id(), ' ', id) as text")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("export", "export")
    robots_files.export_files(rows, str(tmp_path / "out"))
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("export") for s in tracker.getJobInfo(j).stageIds]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(os.listdir(tmp_path / "out")) == 400 and max(s.numTasks for s in stages if s) > 1
    assert (tmp_path / "out" / "7.txt").read_text() == "0 7"


def test_archives_are_read_without_gzipfile_unless_they_are_odd(tmp_path, monkeypatch):
    import random

    def plain(path):
        with gzip.open(path) as f:
            return list(warc._stream_rows(f, ("response",), True, path))

    draw = random.Random(3)
    rows = [(f"https://h{i}.ua/robots.txt", "2024-08-01T00:00:00Z", draw.randbytes(draw.choice([0, 30, 5_000, 300_000])), ("", "gzip", "!gzip", "deflate")[i % 4])
            for i in range(60)]
    good = warc.warc_bytes(rows)
    path = str(tmp_path / "a.warc.gz")
    (tmp_path / "a.warc.gz").write_bytes(good)
    want = plain(path)
    assert len(want) == 60 and all(w[5] == r[2] for w, r in zip(want, rows) if r[3] != "!gzip")
    with monkeypatch.context() as m:
        m.setattr(warc.gzip, "GzipFile", None)  # not opened for a good archive
        m.setattr(warc, "_gunzip", gzip.decompress)
        assert list(warc.read_records(path)) == want
    for data, error in ((good + bytes(1000), None), (good + b"tail", "BadGzipFile"), (good[:-5], "EOFError"), (good[:len(good) // 2], "EOFError"),
                        (good[:-6] + b"x" + good[-5:], "BadGzipFile")):
        (tmp_path / "a.warc.gz").write_bytes(data)
        got = list(warc.read_records(path))
        rest = got if error is None else got[:-1]
        assert rest == want[:len(rest)] and len(rest) >= 20 and (error is None or got[-1][6].startswith(error))


def test_many_archives_share_fetch_tasks(spark, tmp_path):
    names = [f"file://{tmp_path}/robotstxt/{i}.warc.gz" for i in range(300)]
    (tmp_path / "m.paths").write_text("".join(f"{n}\n" for n in names))
    staged = jobs.stage_archives(spark, str(tmp_path / "m.paths"), str(tmp_path / "staged"))
    assert {r["archive_path"] for r in staged.failed.collect()} == set(names)
    assert len(staged.failed.inputFiles()) <= 4 * spark.sparkContext.defaultParallelism < 300


def test_archives_are_written_by_many_tasks_under_stable_names(spark, tmp_path):
    rows = spark.range(400).selectExpr("cast(id % 40 as string) as archive_key", "concat('https://h', id, '.ua/robots.txt') as target_url",
                                       "'2024-08-01T00:00:00Z' as capture_date", "'Sitemap: /s.xml' as body", "'' as content_encoding")
    names = []
    for some in (rows, rows.where("archive_key < 5")):  # fewer bytes, same names: a second run replaces the files
        got = warc.write_warc_files(some, str(tmp_path / "in")).collect()
        names.append({r["archive_path"] for r in got})
        assert sum(r["records"] for r in got) == some.count()
    assert len({n.rsplit("-", 1)[1] for n in names[0]}) > 8 and names[1] < names[0]


@pytest.mark.parametrize("snapshots", [False, True])
def test_rows_by_archive_are_written_by_many_tasks(spark, tmp_path, monkeypatch, snapshots):
    from crawlmeta.sinks import robots_files
    from crawlmeta.sinks import snapshots as snapshot_tables
    monkeypatch.setattr(robots_files, "ROWS_PER_FILE", 50)
    rows = spark.range(520).selectExpr("if(id < 200, 'large', concat('a', id % 40)) as archive_path", "concat('line ', id) as value")
    done = rows.groupBy("archive_path").agg(F.count(F.lit(1)).alias("rows"))
    out = str(tmp_path / "out")
    robots_files.write_by_archive(rows, out, done, "text", snapshots)
    read = lambda: snapshot_tables.read(spark, out) if snapshots else spark.read.text(out)
    parts = [(d, f) for d, _, files in os.walk(out) for f in files if f.startswith("part-") and f.endswith(".txt")]
    per = sorted(sum(x == d for x, _ in parts) for d in {d for d, _ in parts})
    assert len(per) == 41 and per[:40] == [1] * 40 and 2 <= per[40] <= 4 and len({f[:10] for _, f in parts}) > 4
    assert {r["value"] for r in read().select("value").collect()} == {f"line {i}" for i in range(520)}
    robots_files.write_by_archive(rows.where("value = 'line 201'"), out, done.where("archive_path != 'large'"), "text", snapshots)
    assert {r["value"] for r in read().select("value").collect()} == {f"line {i}" for i in [*range(200), 201]}


def test_streams(spark, tmp_path):
    from crawlmeta.streaming import pipelines
    src = tmp_path / "links"
    src.mkdir()
    (src / "a.sitemap-links.tsv").write_text("s\tf\thttps://x/1\ns\tf\t\nbad\n")
    q = pipelines.publish_urls_stream(spark, str(src), str(tmp_path / "ck1"), out_path=str(tmp_path / "out1"))
    q.awaitTermination()
    assert [r["value"] for r in spark.read.text(str(tmp_path / "out1")).collect()] == ['{"url":"https://x/1"}']
    tsvdir = tmp_path / "tsv"
    tsvdir.mkdir()
    (tsvdir / "a.sitemaps.tsv").write_text("/r/example.ua/https-1.txt\texample.ua\thttps\thttps://example.ua/ru/s.xml\n"
                                           "/r/example.com/https-1.txt\texample.com\thttps\thttps://example.com/s.xml\n")
    dim = geo.sample_dimension(spark)
    q = pipelines.filter_sitemaps_stream(spark, str(tsvdir), str(tmp_path / "out2"), str(tmp_path / "ck2"), dim)
    q.awaitTermination()
    got = sorted((r["out_group"], r["out_key"]) for r in spark.read.text(str(tmp_path / "out2")).collect())
    assert got == [("country", "ukraine"), ("language-region", "ru-RU")]


def test_local_country_job(spark, tmp_path):
    src = tmp_path / "tsv"
    src.mkdir()
    (src / "a.sitemaps.tsv").write_text("/r/example.de/https-1.txt\texample.de\thttps\thttps://cdn.example.ua/s.xml\n"
                                        "/r/example.ru/https-1.txt\texample.ru\thttps\thttps://example.ru/s.xml\n")
    res = jobs.local_country_sitemaps_job(spark, str(src), str(tmp_path / "out"), "Ukraine", geo.sample_dimension(spark))
    assert res.metrics == {"read_rows": 2, "malformed_rows": 0, "kept_rows": 1}
    (line,) = [r["value"] for r in spark.read.text(str(tmp_path / "out")).collect()]
    assert line.split("\t")[4:] == ["ukraine", "Ukraine", ".ua", "unknown"]
