import gzip
import random

import pytest
from pyspark.sql import functions as F

from crawlmeta.session import work_folder
from crawlmeta.sources import warc, warc_index


def rows(n, seed=1):
    r = random.Random(seed)
    words = [f"Disallow: /{r.randrange(10**6)}" for _ in range(300)]
    return [(f"https://h{i}.example/{'robots.txt' if i % 4 else 'index.html'}", "2024-08-01T00:00:00Z",
             "\n".join(r.choices(words, k=r.choice([1, 5, 400]))).encode(), ["", "gzip", "!gzip"][i % 3 if i % 10 == 0 else 0])
            for i in range(n)]


def read_all(df):
    return sorted(map(str, ((r.archive_path, r.record_type, r.capture_date, r.target_url, r.content_encoding,
                             r.body and bytes(r.body), r.error) for r in df.collect())))


def both(spark, path, range_bytes, **more):
    """Rows by one task per archive, and through the index."""
    want = read_all(warc.read_warc(spark, path, split_bytes=None, **more))
    index = warc_index.build_index(spark, warc_index.archive_files(path), work_folder(spark, "index"), range_bytes)
    return want, index


def test_one_archive_is_many_tasks_with_the_same_rows(spark, tmp_path):
    path = tmp_path / "a.warc.gz"
    path.write_bytes(warc.warc_bytes(rows(400)))
    size = path.stat().st_size
    want, index = both(spark, str(tmp_path), size // 20)
    assert index.whole.count() == 0
    got = warc_index.read_indexed(index, range_bytes=size // 20)
    assert read_all(got) == want and len(want) == 300
    assert any("Body decode failed" in r for r in want)
    tasks = got.groupBy(F.spark_partition_id()).count().count()
    assert tasks >= 8


def test_everything_and_a_selection(spark, tmp_path):
    for k in range(3):
        (tmp_path / f"{k}.warc.gz").write_bytes(warc.warc_bytes(rows(60, k)))
    more = {"robots_only": False, "record_types": "response,request,warcinfo"}
    want, index = both(spark, str(tmp_path), 3000, **more)
    types = ("response", "request", "warcinfo")
    assert read_all(warc_index.read_indexed(index, types, False)) == want
    some = warc_index.read_indexed(index, where="target_url LIKE '%h7.%'").collect()
    assert [r.target_url for r in some] == ["https://h7.example/robots.txt"] * 3


def test_magic_bytes_inside_a_member_are_not_believed(spark, tmp_path):
    inner = warc.warc_bytes(rows(30, 5), with_noise=True)
    noise = random.Random(4).randbytes(20_000)
    record = lambda url, body: warc._record([
        ("WARC-Type", "response"), ("WARC-Target-URI", url), ("WARC-Date", "2024-08-01T00:00:00Z")],
        b"HTTP/1.1 200 OK\r\n\r\n" + body)
    stored = [gzip.compress(gzip.decompress(record(f"https://o{i}.example/robots.txt", noise + inner + noise)), compresslevel=0)
              for i in range(4)]
    (tmp_path / "trap.warc.gz").write_bytes(b"".join(stored))
    want, index = both(spark, str(tmp_path), 9_000)
    assert len(want) == 4 and index.whole.count() == 1  # the walks do not fit: read from its start
    assert read_all(warc_index.read_indexed(index)) == want
    want, index = both(spark, str(tmp_path), 1 << 20)
    assert index.whole.count() == 0 and read_all(warc_index.read_indexed(index)) == want


@pytest.mark.parametrize("damage", ["cut", "garbage", "one member", "empty", "zero bytes after", "record over members", "not gzip"])
def test_damaged_and_other_archives_give_the_same_rows(spark, tmp_path, damage):
    data = warc.warc_bytes(rows(40))
    plain = gzip.decompress(data)
    data = {"cut": data[:-50], "garbage": data + b"garbage", "one member": gzip.compress(plain), "empty": b"",
            "zero bytes after": data + bytes(100), "record over members": gzip.compress(plain[:5000]) + gzip.compress(plain[5000:]),
            "not gzip": b"hello"}[damage]
    (tmp_path / "x.warc.gz").write_bytes(data)
    (tmp_path / "y.warc.gz").write_bytes(warc.warc_bytes(rows(10, 3)))
    want, index = both(spark, str(tmp_path), 700)
    assert read_all(warc_index.read_indexed(index)) == want
    assert index.whole.count() == (0 if damage == "one member" else 1)


def test_plain_archives(spark, tmp_path):
    (tmp_path / "p.warc").write_bytes(gzip.decompress(warc.warc_bytes(rows(50))))
    (tmp_path / "q.warc").write_bytes(gzip.decompress(warc.warc_bytes(rows(50)))[:-200])
    want, index = both(spark, str(tmp_path), 1000)
    got = warc_index.read_indexed(index, range_bytes=1000)
    assert read_all(got) == want and index.whole.count() == 1
    assert index.entries.where("record_no > 0").count() == 0


def test_read_warc_splits_large_archives_only(spark, tmp_path):
    (tmp_path / "small.warc.gz").write_bytes(warc.warc_bytes(rows(3)))
    (tmp_path / "large.warc.gz").write_bytes(warc.warc_bytes(rows(200)))
    want = read_all(warc.read_warc(spark, str(tmp_path), split_bytes=None))
    assert read_all(warc.read_warc(spark, str(tmp_path), split_bytes=5000)) == want
    table = spark.createDataFrame([(f"{tmp_path}/{n}.warc.gz\tname-{n}",) for n in ("small", "large")], "value string")
    table.write.text(str(tmp_path / "table"))
    got = warc.read_warc(spark, path_table=str(tmp_path / "table"), split_bytes=5000)
    assert {r.archive_path for r in got.collect()} == {"name-small", "name-large"} and got.count() == len(want)


def test_no_archives(spark, tmp_path):
    want, index = both(spark, str(tmp_path), 1000)
    assert want == [] == warc_index.read_indexed(index).collect()
