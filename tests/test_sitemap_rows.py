import gzip
import random

from pyspark.sql import functions as F

from crawlmeta.operators import sitemap_rows
from crawlmeta.operators.sitemap_docs import LOCATIONS, SITEMAP_NS, parse_sitemaps
from tests.test_sitemap_docs import document


def as_documents(rows):
    """(kind, locs, error) per URL, from rows in any order."""
    out = {}
    for r in rows:
        out.setdefault(r.url, []).append((r.loc_no, r.kind, r.loc, r.error))
    made = {}
    for url, found in out.items():
        (_, kind, none, error), *locs = sorted(found, key=lambda x: x[0])
        assert none is None and [n for n, *_ in locs] == list(range(1, len(locs) + 1))
        assert all(k == kind and e is None for _, k, _, e in locs)
        made[url] = (kind, [x for _, _, x, _ in locs] or None, error)
    return made


def both(spark, bodies):
    df = spark.createDataFrame([(str(i), b if isinstance(b, (bytes, type(None))) else b.encode()) for i, b in enumerate(bodies)],
                               "url string, body binary")
    want = {r.url: (r.doc.kind, list(r.doc.locs) if r.doc.locs else None, r.doc.error) for r in parse_sitemaps(df).collect()}
    return as_documents(sitemap_rows.location_rows(df).collect()), want


def bodies():
    r = random.Random(6)
    urls = [f"https://t.test/{i}?a&b={i * i}" for i in range(11_000)]
    plain = [document(root, urls[:k] + urls[:3], SITEMAP_NS if root in ("urlset", "sitemapindex") else "", " \n")
             for root in LOCATIONS for k in (0, 1, 40)]
    large = [document("urlset", urls * 2), document("sitemapindex", urls), document("feed", urls[:9000])]
    odd = ["", " \n", "<page/>", "<urlset xmlns='urn:x'/>", "<sitemapindex><sitemap>", "<!-- note -->", "https://t.test/1\nhttps://t.test/2",
           "https://t.test/1\nno", None, b"\x1f\x8bno gzip", b"\xff\xfe<", "<?xml version='1.0' encoding='nonsense'?><urlset/>",
           '<!DOCTYPE u [<!ENTITY e "x">]><urlset><url><loc>https://t.test/&e;</loc></url></urlset>',
           "<?xml version='1.0' encoding='windows-1251'?><urlset><url><loc>https://t.test/д</loc></url></urlset>".encode("cp1251"),
           "<?xml version='1.0' encoding='iso-8859-1'?><urlset><url><loc>https://t.test/\xe9</loc></url></urlset>".encode("latin-1"),
           "﻿" + document("urlset", urls[:2]), document("urlset", urls[:9000])[:-30], large[0][:len(large[0]) // 2]]
    every = plain + large + odd
    packed = [gzip.compress(b if isinstance(b, bytes) else b.encode()) for b in every if b is not None]
    cut = [packed[0][:-5], packed[len(plain)][:2000], packed[len(plain)][:-4], gzip.compress(b"<page/>" + r.randbytes(3000))[:-9]]
    return every + packed + cut + [packed[1] + packed[2]]


def test_rows_are_those_of_the_documents(spark):
    got, want = both(spark, bodies())
    for url in want:
        assert got[url] == want[url], url
    assert got.keys() == want.keys()
    kinds = {k for k, _, _ in got.values()}
    assert kinds == {"urlset", "sitemapindex", "invalid", "failed"}


def test_a_long_document_leaves_in_small_batches():
    import pyarrow as pa
    body = document("urlset", [f"https://t.test/{i}" for i in range(60_000)]).encode()
    batch = pa.RecordBatch.from_arrays([pa.array(["u"]), pa.array([gzip.compress(body)])], names=["url", "body"])
    sizes = [b.num_rows for b in sitemap_rows._emit(iter([batch]))]
    assert sum(sizes) == 60_001 and max(sizes) <= 2 * sitemap_rows.BATCH and len(sizes) > 10
    parts = list(sitemap_rows._chunks(gzip.compress(body)))
    assert b"".join(parts) == body and max(map(len, parts)) <= sitemap_rows._CHUNK


def test_no_documents(spark):
    assert sitemap_rows.location_rows(spark.createDataFrame([], "url string, body binary")).collect() == []
    assert sitemap_rows.location_rows(spark.createDataFrame([("a", "https://x/1")], "url string, body string")).where(
        F.col("loc_no") == 1).first().loc == "https://x/1"
