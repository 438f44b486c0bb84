import gzip
import os

import pytest
from pyspark.sql import functions as F

from crawlmeta.operators import geo
from crawlmeta.sources import manifest_stream, warc
from crawlmeta.streaming import ledger as ledger_mod
from crawlmeta.streaming import pipelines
from crawlmeta.streaming.ledger import Ledger, file_target


def archive(folder, name, body, error=False):
    os.makedirs(f"{folder}/seg/robotstxt", exist_ok=True)
    data = b"no archive" if error else warc.warc_bytes([(f"https://{name}.example.ua/robots.txt", "2024-08-01T00:00:00Z", body, "gzip")])
    with open(f"{folder}/seg/robotstxt/{name}.warc.gz", "wb") as f:
        f.write(data)
    return f"seg/robotstxt/{name}.warc.gz"


def lines(spark, out):
    return spark.read.schema("value string, out_group string, out_key string").text(out).collect()


@pytest.mark.parametrize("packed", [False, True])
def test_each_archive_of_a_growing_manifest_appears_once(spark, tmp_path, packed):
    root, out, ck = str(tmp_path / "a"), str(tmp_path / "out"), str(tmp_path / "ck")
    manifest = f"{tmp_path}/paths" + (".gz" if packed else "")
    dim = geo.sample_dimension(spark)

    def append(text):
        with open(manifest, "ab") as f:
            f.write(gzip.compress(text.encode()) if packed else text.encode())

    def run():
        pipelines.archive_links_stream(spark, manifest, out, ck, dim, archive_root=f"{root}/x/..").awaitTermination()
        return sorted((r.out_group, r.out_key, r.value.split("\t")[0]) for r in lines(spark, out)) if any("=" in n for n in os.listdir(out)) else []

    assert run() == []  # no manifest yet
    one = archive(root + "/x", "one", b"Sitemap: /ru/1.xml\n") and archive(root, "one", b"Sitemap: /ru/1.xml\n")
    append(f"# comment\n\n  {one}\t\nsegment/other.warc.gz\n")
    first = [("country", "ukraine", one), ("language-region", "ru-RU", one)]
    assert run() == first and run() == first
    bad, half = archive(root, "bad", b"", error=True), archive(root, "half", b"Sitemap: /2.xml\n")
    append(f"{bad}\n{half}")
    second = sorted(first + [("failed", "archive", bad)])
    assert run() == second  # the last line is still being written
    append("\n")
    assert run() == sorted(second + [("country", "ukraine", half), ("language-region", "unknown", half)])


def test_a_manifest_that_changes_behind_the_position_stops_the_query(tmp_path):
    path = tmp_path / "paths"
    path.write_text("a/robotstxt/1.warc.gz\n")
    reader = manifest_stream._ManifestReader({"manifest": str(path), "archiveRoot": "/r/"})
    end = reader.latestOffset()
    assert [p.value for p in reader.partitions(reader.initialOffset(), end)] == [[("/r/a/robotstxt/1.warc.gz", "a/robotstxt/1.warc.gz")]]
    path.write_text("b/robotstxt/1.warc.gz\nc/robotstxt/1.warc.gz\n")
    with pytest.raises(ValueError, match="have changed"):
        reader.partitions(end, reader.latestOffset())


def test_small_archives_share_a_partition(tmp_path):
    names = [f"{tmp_path}/robotstxt/{i}.warc.gz" for i in range(300)]
    some = warc.packed([(n, n) for n in names], 10)
    assert [f for part in some for f, _ in part] == names and len(some) == 10
    assert warc.packed([], 10) == [] and len(warc.packed([(n, n) for n in names[:4]], 10)) == 4
    sizes = {n: warc.PARTITION_BYTES // 2 for n in names}
    assert {len(part) for part in warc.packed([(n, n) for n in names], 1, sizes)} == {2}


def links(folder, name, urls):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.sitemap-links.tsv", "w") as f:
        f.write("".join(f"s\tm\t{u}\n" for u in urls))


def test_a_url_is_published_once_also_after_a_restart(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")

    def run():
        pipelines.publish_urls_stream(spark, src, str(tmp_path / "ck"), out, once_within="30 days").awaitTermination()
        return sorted(r.value for r in spark.read.text(out).collect())

    links(src, "a", ["u1", "u2", "u1"])
    assert run() == ['{"url":"u1"}', '{"url":"u2"}']
    links(src, "b", ["u2", "u3", "u3", "", "u1"])
    assert run() == ['{"url":"u1"}', '{"url":"u2"}', '{"url":"u3"}']


def test_state_expires(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")

    def run():
        q = pipelines.publish_urls_stream(spark, src, str(tmp_path / "ck"), out, once_within="1 millisecond")
        q.awaitTermination()
        return q.lastProgress.stateOperators[0].numRowsTotal

    for name in "abcd":
        links(src, name, [f"{name}{i}" for i in range(50)])
        left = run()
    assert left <= 100  # not the 200 URLs of all batches


def sent(folder):
    out = []
    for name in os.listdir(folder) if os.path.isdir(folder) else []:
        with open(f"{folder}/{name}") as f:
            out += f.read().splitlines()
    return sorted(out)


class Broken(RuntimeError):
    pass


def failing(target, after):
    """A target whose connection breaks after so many chunks of a task."""
    def opened():
        send, left = target(), [after]

        def limited(values):
            if not left[0]:
                raise RuntimeError("connection lost")
            left[0] -= 1
            send(values)

        return limited

    return opened


def test_a_replayed_batch_sends_nothing_twice(spark, tmp_path):
    values = spark.range(500).select(F.concat(F.lit("v"), F.col("id")).alias("value")).repartition(3)
    book, out = Ledger(spark, str(tmp_path / "ledger"), chunk=40), str(tmp_path / "out")
    with pytest.raises(Exception, match="connection lost"):
        book.publish(values, 7, failing(file_target(out), 2))
    before = len(sent(out))
    assert 0 < before < 500 and book.totals() == {}
    # The replay gets other rows and another order; what was staged counts.
    assert book.publish(values.orderBy("value").limit(10), 7, file_target(out)) == 500 - before
    assert sent(out) == sorted(f"v{i}" for i in range(500))
    assert book.publish(values, 7, file_target(out)) == 0 and len(sent(out)) == 500
    assert book.totals() == {"rows": 500, "sent": 500}
    assert {(r.records, r.acked) for r in book.notes(7).collect()} == {(r.records, r.records) for r in book.notes().collect()}


def test_a_batch_cut_off_while_staging_is_staged_again(spark, tmp_path, monkeypatch):
    book, out = Ledger(spark, str(tmp_path / "ledger")), str(tmp_path / "out")
    values = spark.createDataFrame([("a",), (None,), ("b",)], "value string")
    monkeypatch.setattr(ledger_mod, "_write_json", lambda *a: (_ for _ in ()).throw(Broken("lost")))
    with pytest.raises(Broken):
        book.stage(values, 1)
    monkeypatch.undo()
    assert book.publish(values, 1, file_target(out)) == 2 and sent(out) == ["a", "b"]
    assert book.publish(values.limit(0), 2, file_target(out)) == 0 and book.totals() == {"rows": 3, "sent": 2}
    with pytest.raises(ValueError):
        Ledger(spark, "x", chunk=0)


def test_ledger_stream_counts_and_restarts(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    book = Ledger(spark, str(tmp_path / "ledger"), chunk=2)
    links(src, "a", ["u1", "", "u2", "u3"])
    go = lambda t: pipelines.publish_with_ledger_stream(spark, src, str(tmp_path / "ck"), book, t).awaitTermination()
    with pytest.raises(Exception, match="connection lost"):
        go(failing(file_target(out), 1))
    links(src, "b", ["u4"])
    go(file_target(out))
    assert sent(out) == [f'{{"url":"u{i}"}}' for i in range(1, 5)]
    assert book.totals() == {"rows": 5, "malformed_rows": 1, "sent": 4}
