import gzip
import hashlib
import random
import zipfile
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from crawlmeta.llm import warc_zip
from crawlmeta.llm.common import shared_folder

from . import odd

PAGES = "page_id long, url string, html string, file string, h long, largest int, id string, n int"


def brute(rows, least=1000):
    groups = {}
    for i, _, t in rows:
        groups.setdefault((t or "").encode(), []).append(i)
    out = []
    for i, _, t in rows:
        data = (t or "").encode()
        ids = [x for x in groups[data] if x is not None]
        largest = max(ids) if ids and len(data) >= least else None
        to = largest if largest is not None and i != largest else None
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "response" if to is None else "revisit", to))
    return sorted(out, key=str)


def got(df):
    rows = df.collect()
    assert not [r for r in rows if r.error]
    return sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows], key=str)


def odd_pages(spark):
    big, other = "<p>é日本</p>" * 200, "x" * 999
    r = random.Random(3)
    noise = "".join(chr(r.randint(1, 0x2fff)) for _ in range(300_000))
    rows = [(1, "http://a/ b\r\nX: y", big), (2, None, big), (2, "http://a/", big), (None, "", big), (4, "http://b/", other),
            (5, "http://b/", other), (6, "http://c/", other + "y"), (7, "http://c/", other + "y"), (8, None, None), (9, "u", ""),
            (None, None, None), (10, "http://日本/\t", "a\r\n\r\nb" * 500), (11, "http://d/", noise), (12, "http://d/", noise),
            (None, "http://e/", "z" * 2000), (None, "http://e/", "z" * 2000), (-3, "http://f/", "q" * 1000), (-4, "g", "q" * 1000)]
    return rows, spark.createDataFrame([(*x, "f", 1, 2, "i", 3) for x in rows], PAGES)


@pytest.mark.parametrize("package_bytes", [1, 5000, 1 << 27])
def test_odd_rows(spark, package_bytes):
    rows, pages = odd_pages(spark)
    packages = warc_zip.write(pages, shared_folder(spark, "zip"), package_bytes=package_bytes)
    records = warc_zip.read(packages)
    assert got(warc_zip.resolved(records)) == brute(rows)
    held = sorted(bytes(r.payload) for r in records.where("record_type = 'response'").collect())
    assert set(held) == {(t or "").encode() for _, _, t in rows}
    if package_bytes == 1:
        assert packages.count() == len(rows)
    urls = {r.url for r in records.collect()}
    assert "http://a/%20b%0D%0AX:%20y" in urls and "<urn:record:8>" in urls


def test_packages_are_plain_zip_and_gzip_files(spark):
    rows, pages = odd_pages(spark)
    packages = warc_zip.write(pages, shared_folder(spark, "zip"))
    total = 0
    for r in packages.collect():
        with zipfile.ZipFile(r.file.removeprefix("file:")) as z:
            assert z.testzip() is None and z.getinfo(warc_zip.ARCHIVE).compress_type == zipfile.ZIP_STORED
            total += gzip.decompress(z.read(warc_zip.ARCHIVE)).count(b"WARC/1.1\r\n")
            lines = z.read(warc_zip.INDEX).decode().splitlines()
            assert lines == sorted(lines) and len(lines) == r.records
    assert total == len(rows)


def test_zip64_directories_and_packed_index(spark, monkeypatch, tmp_path):
    path = str(tmp_path / "wide.wacz")
    record = warc_zip._record("<urn:record:7>", None, "http://a/", b"body", hashlib.sha1(b"body").hexdigest())
    packed = gzip.compress(record)
    line = b'k 1 {"url": "http://a/", "type": "response", "id": "<urn:record:7>", "offset": 0, "length": %d}' % len(packed)
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 10)
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("notes.txt", b"x" * 100)
        z.writestr(zipfile.ZipInfo(warc_zip.ARCHIVE), packed)
        z.writestr(warc_zip.INDEX, line, compress_type=zipfile.ZIP_DEFLATED)
    monkeypatch.undo()
    want = {i.filename: i for i in zipfile.ZipFile(path).infolist()}
    comment = b"PK\x05\x06 a comment that looks like the end of a directory"
    data = open(path, "rb").read()[:-2] + len(comment).to_bytes(2, "little") + comment
    open(path, "wb").write(data)
    assert b"PK\x06\x06" in data and b"PK\x06\x07" in data
    packages = spark.createDataFrame([(path, len(data), 1)], warc_zip.MANIFEST)
    for m in warc_zip.members(packages).collect():
        i = want.pop(m.member)
        assert (m.method, m.packed, m.size) == (i.compress_type, i.compress_size, i.file_size)
        if m.method == 0:
            assert zlib.crc32(data[m.start:m.start + m.packed]) == i.CRC
    assert not want
    (r,) = warc_zip.read(packages).collect()
    assert (r.record_id, bytes(r.payload), r.error) == ("<urn:record:7>", b"body", None)


def test_damage_is_a_row_and_the_rest_is_read(spark, tmp_path):
    rows, pages = odd_pages(spark)
    packages = warc_zip.write(pages, shared_folder(spark, "zip"))
    broken, no_index = str(tmp_path / "a.wacz"), str(tmp_path / "b.wacz")
    open(broken, "wb").write(b"this is no package")
    with zipfile.ZipFile(no_index, "w") as z:
        z.writestr("a", b"b")
    both = packages.union(spark.createDataFrame([(broken, 18, 0), (no_index, 100, 0), (str(tmp_path / "gone"), 1, 0)], warc_zip.MANIFEST))
    records = warc_zip.read(both).collect()
    assert len([r for r in records if r.error]) == 3 and len(records) == len(rows) + 3
    entry_rows = warc_zip.index(packages).withColumn("length", F.col("length") - 30)
    assert all(r.error for r in warc_zip.read(packages, entry_rows).collect())
    lost = warc_zip.resolved(warc_zip.read(packages).where("record_type = 'revisit'")).collect()
    assert lost and {r.error for r in lost} == {"no response to refer to"}


def test_a_selection_of_the_index_is_read(spark):
    rows, pages = odd_pages(spark)
    packages = warc_zip.write(pages, shared_folder(spark, "zip"))
    chosen = warc_zip.index(packages).where("url = 'http://d/' AND record_type = 'response'")
    (r,) = warc_zip.read(packages, chosen).collect()
    assert r.record_id == "<urn:record:12>" and bytes(r.payload).decode() == {x[0]: x[2] for x in rows}[12]


def test_empty_table(spark):
    _, pages = odd_pages(spark)
    packages = warc_zip.write(pages.limit(0), shared_folder(spark, "zip"))
    assert packages.count() == 0 and warc_zip.resolved(warc_zip.read(packages)).collect() == []


def test_query_equals_its_sql(spark):
    df = entry.queries()["op11_warc_zip"](spark, odd.SF)
    pages = duckdb.sql(f"select * from '{odd.SF}/pages.parquet'")  # noqa: F841  (named in the SQL)
    want = duckdb.sql(entry.oracle_sql()["op11_warc_zip"])
    assert sorted(df.columns) == sorted(want.columns)
    assert sorted(map(str, map(tuple, df.select(*want.columns).collect()))) == sorted(map(str, want.fetchall()))
