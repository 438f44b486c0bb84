import gzip
import re

import pytest
from pyspark.sql import functions as F

from crawlmeta.functions.resolve import full_resolve, is_normal_absolute, java_resolve, normalize_path
from crawlmeta.operators.sitemap_docs import ATOM_NS, LOCATIONS, SITEMAP_NS, parse_sitemaps, read_locations


def parse(spark, *bodies):
    rows = [(i, b if isinstance(b, (bytes, type(None))) else b.encode()) for i, b in enumerate(bodies)]
    out = parse_sitemaps(spark.createDataFrame(rows, "i int, body binary")).orderBy("i").collect()
    return [(r.doc.kind, None if r.doc.locs is None else list(r.doc.locs), r.doc.error) for r in out]


def document(root, urls, ns="", pad=""):
    """A document of the given kind with each URL in an entry of its own."""
    entry, leaf, attribute = LOCATIONS[root]
    def leaf_of(u):
        u = u.replace("&", "&amp;")
        return f'<{leaf} {attribute}="{u}"/>' if attribute else f"<{leaf}>{pad}{u}{pad}</{leaf}>"
    body = "".join(f"<{entry}>{leaf_of(u)}</{entry}>" for u in urls)
    return f'<{root}{f" xmlns={chr(34)}{ns}{chr(34)}" if ns else ""}>{body}</{root}>'


@pytest.mark.parametrize("root", list(LOCATIONS))
def test_every_kind_gives_its_urls_once_in_order(spark, root):
    urls = [f"https://shop{i % 3}.test/item?id={i}&k={i * i}" for i in range(7)]
    namespaces = {"": True, SITEMAP_NS: True, ATOM_NS: root in ("feed", "rss"), "urn:other": root == "rss"}
    kind = "sitemapindex" if root == "sitemapindex" else "urlset"
    got = parse(spark, *(document(root, urls + urls[2:4], ns, " \n\t") for ns in namespaces))
    for (ns, fits), result in zip(namespaces.items(), got):
        assert result == ((kind, urls, None) if fits else ("invalid", None, f"Unsupported sitemap namespace: {ns}"))


def test_urls_outside_the_place_of_a_kind_do_not_count(spark):
    nested = ("<urlset><loc>https://t.test/0</loc><url><video><loc>https://t.test/1</loc></video>"
              "<loc><![CDATA[ https://t.test/2?a&b ]]></loc><note>https://t.test/3</note></url></urlset>")
    channel = "<rss><channel><link>https://t.test/4</link><item><source><link>https://t.test/5</link></source><link>https://t.test/6</link></item></channel></rss>"
    links = ('<feed><link href="https://t.test/7"/><entry><link rel=" ALTERNATE" href="https://t.test/8"/>'
             '<link rel="edit" href="https://t.test/9"/><link/></entry></feed>')
    closed = "<urlset><url><url><loc>https://t.test/10</loc></url><loc>https://t.test/11</loc></url></urlset>"
    got = parse(spark, nested, channel, links, closed)
    assert [g[1] for g in got] == [["https://t.test/2?a&b"], ["https://t.test/6"], ["https://t.test/8"], ["https://t.test/10"]]


def test_each_error_is_a_value(spark):
    cases = {
        "<page/>": "Unsupported sitemap root element: page",
        "<urlset xmlns='urn:x'/>": "Unsupported sitemap namespace: urn:x",
        "<rss><channel/></rss>": "Sitemap rss document does not contain any loc entries",
        "<sitemapindex><sitemap>": "Invalid sitemap XML: ",
        "<!-- only a note -->": "Invalid sitemap XML: ",
        "": "Text sitemap document is empty",
        "\r\n \n": "Text sitemap document is empty",
        "https://t.test/ok\r\nftp://t.test/no": "Invalid text sitemap URL: ftp://t.test/no",
        "https://t.test//twice": "Invalid text sitemap URL: https://t.test//twice",
        '<!DOCTYPE u [<!ENTITY e "x">]><urlset><url><loc>https://t.test/&e;</loc></url></urlset>': "Invalid sitemap XML: entity",
        '<!DOCTYPE u SYSTEM "file:///etc/hostname"><urlset/>': "Sitemap urlset document does not contain",
        document("urlset", ["https://t.test/a"]) + "<late": "Invalid sitemap XML: ",
    }
    for (body, message), got in zip(cases.items(), parse(spark, *cases)):
        assert got[:2] == ("invalid", None) and got[2].startswith(message), body


def test_text_lists_gzip_and_missing_bodies(spark):
    urls = ["https://t.test/" + x for x in "cab"]
    body = document("urlset", urls)
    got = parse(spark, "\ufeff" + "\r".join(["", *urls, urls[0], " "]), gzip.compress(body.encode()), gzip.compress(urls[0].encode()),
                gzip.compress(body.encode())[:-12], b"\x1f\x8b", None, "\ufeff \n" + body)
    assert got[0] == got[1] == got[6] == ("urlset", urls, None)
    assert got[2] == ("urlset", urls[:1], None)
    assert [g[0] for g in got[3:6]] == ["failed"] * 3
    assert got[3][2].startswith("Invalid gzip stream: ") and got[5][2] == "No document"


@pytest.mark.parametrize("encoding", ["Shift_JIS", "gb2312", "euc-kr", "ISO-8859-2", "windows-1251", "UTF-16"])
def test_declared_encodings(spark, encoding):
    word = {"Shift_JIS": "日本", "gb2312": "中国", "euc-kr": "한국", "windows-1251": "мир"}.get(encoding, "é")
    text = f'<?xml version="1.0" encoding="{encoding}"?>' + document("urlset", [f"https://t.test/{word}"])
    got = parse(spark, text.encode(encoding)) if encoding != "UTF-16" else [("urlset", read_locations(text.encode(encoding))[2], None)]
    assert got == [("urlset", [f"https://t.test/{word}"], None)]


def test_unknown_encoding_is_a_value(spark):
    assert parse(spark, '<?xml version="1.0" encoding="x-none"?><urlset/>')[0][2].startswith("Invalid sitemap XML: unknown encoding")


def java(spark, base, ref):
    """What java.net.URI and the page-URL check give, by way of the JVM."""
    uri = spark.sparkContext._jvm.java.net.URI
    try:
        out = uri(base).resolve(uri(ref)).normalize()
    except Exception:  # noqa: BLE001  (a syntax error in the JVM)
        return None
    text = out.toString()
    ok = (out.getScheme() or "").lower() in ("http", "https") and out.getRawAuthority() and not out.isOpaque()
    return text if ok and not re.search(r"[\s\x00-\x1f\x7f-\x9f]", text) else None


def test_resolution_is_that_of_java(spark):
    import random
    r = random.Random(17)
    bits = ["a", "b.c", ".", "..", "...", "", "%41", "é", "x;p=1", "~", "q q", "%zz", "a:b"]
    schemes = ["", "", "", "http:", "HTTPS:", "ftp:", "mailto:", "1x:"]
    def ref():
        s = r.choice(schemes)
        host = r.choice(["", "", "//h.test", "//h.test:80", "//h.test:", "//ex_a.test", "//"])
        path = r.choice(["", "/", "//"]) + "/".join(r.choice(bits) for _ in range(r.randint(0, 5)))
        return s + host + path + r.choice(["", "", "?", "?a=b&c", "?x[1]"]) + r.choice(["", "", "#", "#f", "#f#g"])
    bases = ["https://t.test/dir/page.xml?q#f", "https://t.test", "http://t.test:81/a/../b//c/", "mailto:x@y"]
    cases = [(r.choice(bases), ref()) for _ in range(700)]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, b string, c string")
    got = [x.r for x in df.select("i", java_resolve("b", "c").alias("r")).orderBy("i").collect()]
    wrong = [(c, g, java(spark, *c)) for c, g in zip(cases, got) if g != java(spark, *c)]
    assert not wrong, (len(wrong), wrong[:5])


def test_long_references_do_not_overflow(spark):
    n = 100_000
    longs = ["https://t.test/" + "a" * n, "https://t.test/?" + "q=1&" * (n // 4), "https://t.test/" + "%41" * (n // 3),
             "https://t.test/" + "a/" * (n // 2), "https://t.test/" + "a/./" * (n // 4) + "z", "https://t.test/#" + "f" * n,
             "https://t.test/" + "a/../" * (n // 5) + "z", "https://t.test/" + "a/" * (n // 4) + "../" * (n // 6) + "z",
             "/" + "b" * n, "?" + "%20" * (n // 3), "../" * (n // 3) + "z"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(longs)], "i int, u string").repartition(2)
    base = F.lit("https://t.test/x/y")
    got = [x.r for x in df.select("i", java_resolve(base, "u").alias("r")).orderBy("i").collect()]
    assert got[:4] == longs[:4] and got[5] == longs[5]
    assert got[4] == "https://t.test/" + "a/" * (n // 4) + "z" and got[6] == "https://t.test/z"
    assert got[7] == "https://t.test/" + "a/" * (n // 4 - n // 6) + "z"
    assert got[8] == "https://t.test" + longs[8] and got[9] == "https://t.test/x/" + longs[9]
    assert got[10] == "https://t.test/" + "../" * (n // 3 - 1) + "z"
    text = "\n".join(u for u in longs[:4])
    assert parse(spark, text)[0][0] == "urlset"


def test_short_cut_agrees_with_the_rules(spark):
    import duckdb

    from tests.conftest import SF001
    urls = [x[0] for x in duckdb.sql(f"select url from '{SF001}/pages.parquet'").fetchall()]
    odd = ["https://h", "http://h:8080/a/b/?q=1&r=2#f", "https://h/a%20b", "https://h/a//b", "https://h/./a", "https://h/a/..",
           "https://h/a/...", "https://h/.a/b.", "https://h:/a", "HTTPS://h/x", "https://h/a?b//c/../d", "https://h#/../x"]
    df = spark.createDataFrame([(u,) for u in urls + odd], "u string")
    rows = df.select("u", is_normal_absolute(F.col("u")).alias("short"),
                     full_resolve(F.lit("https://t.test/dir/root.xml"), F.col("u")).alias("full")).collect()
    assert all(r.full == r.u for r in rows if r.short) and sum(r.short for r in rows) >= len(urls) + 6


def _cancelled(path):
    """Segments kept by repeated cancelling of a plain segment before '..'."""
    if not re.search(r"//|(^|/)\.\.?(/|$)", path):
        return path
    segs = re.findall(r"[^/]+/?", path)
    segs = [s for s in segs if s.rstrip("/") != "."]
    k = 1
    while k < len(segs):
        if segs[k].rstrip("/") == ".." and segs[k - 1].rstrip("/") != "..":
            del segs[k - 1:k + 1]
            k = max(1, k - 1)
        else:
            k += 1
    return ("/" if path.startswith("/") else "") + "".join(segs)


def test_normalize_path_random(spark):
    import random
    r = random.Random(5)
    bits = ["a", "b", ".", "..", "..", "", "c.d", "...", ".x"]
    paths = ["/" * r.randint(0, 2) + "/".join(r.choice(bits) for _ in range(r.randint(0, 8))) + r.choice(["", "/"]) for _ in range(900)]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    for x in df.select("p", normalize_path(F.col("p")).alias("n")).collect():
        assert x.n == _cancelled(x.p), x.p
