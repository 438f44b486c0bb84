from pyspark.sql import functions as F

from crawlmeta.functions import html, text, url
from crawlmeta.sources import manifest
from tests.conftest import one


def test_java_trim_and_slug(spark):
    assert one(spark, text.java_trim, "\x00\t x \x1f") == "x"
    assert one(spark, text.java_trim, " x ") == " x "
    assert one(spark, text.slug, "  Côte d'Ivoire ") == "c-te-d-ivoire"
    assert one(spark, text.slug, "--Russian Federation!--") == "russian-federation"


def test_url_helpers(spark):
    assert one(spark, url.url_host, "example.ua/x") == "example.ua"
    assert one(spark, url.url_host, "https://ex_ample.ua/x") == "https"
    assert one(spark, url.url_host, "/sitemap.xml") is None
    assert one(spark, url.normalize_host, " Example.УКР. ") == "example.xn--j1amh"
    assert one(spark, url.normalize_suffix, " .рф") == ".xn--p1ai"
    assert one(spark, url.is_robots_target, "https://x/A/Robots.TXT?x=1") is True
    assert one(spark, url.is_robots_target, "https://x/robots%2Etxt") is True
    assert one(spark, url.is_robots_target, "not a url/robots.txt") is False
    assert one(spark, url.is_usable_sitemap_value, "HTTPS://x/s.xml") is True
    assert one(spark, url.is_usable_sitemap_value, "//x/s.xml") is True
    assert one(spark, url.is_usable_sitemap_value, "https://x/　s.xml") is False
    assert one(spark, url.archive_uri, "/crawl-data/a.warc.gz") == "https://data.commoncrawl.org/crawl-data/a.warc.gz"
    assert one(spark, url.archive_uri, "s3://b/a.warc.gz") == "s3://b/a.warc.gz"
    assert one(spark, url.manifest_url, "https://h/crawl-data/CC/wat.paths.gz") == \
        "https://h/crawl-data/CC/robotstxt.paths.gz"
    assert manifest.resolve_manifest_path("/x/wat.paths.gz") == "/x/robotstxt.paths.gz"


def test_html_unescape(spark):
    got = one(spark, html.html_unescape, "a&amp;lt;b &#x41;&#66;&#x1F600; &bogus; &#99999999999; &nbsp;x &copy;")
    assert got == "a&lt;b AB\U0001F600 &bogus; &#99999999999;  x &copy;"


def test_root_zone_suffix_rows(spark):
    index = ('<table><tr>\n<td><span class="domain tld"><a href="/domains/root/db/ua.html">.ua</a></span></td>'
             '\n<td>country-code</td>\n</tr><tr><td><span class="domain tld"><a href="/domains/root/db/com.html">'
             '.com</a></span></td><td>generic</td></tr><tr><td><span class="domain tld">'
             '<a href="/domains/root/db/xn--j1amh.html">.укр</a></span></td><td>country&#45;code</td></tr></table>')
    details = [("/domains/root/db/ua.html", "<!-- (Country-code top-level domain designated for Ukraine) -->"),
               ("/domains/root/db/xn--j1amh.html",
                "<p><!-- (Country-code top-level domain designated for Ukraine) --></p>"),
               ("/domains/root/db/com.html", "")]
    idx = spark.createDataFrame([(index,)], "html string")
    det = spark.createDataFrame(details, "href string, html string")
    rows = html.suffixes_from_root_zone_pages(idx, det).collect()
    assert [(r["country_key"], r["country_name"], r["suffix"]) for r in rows] == [
        ("ukraine", "Ukraine", ".ua"), ("ukraine", "Ukraine", ".xn--j1amh")]


def test_anchor_rows(spark):
    df = spark.createDataFrame([(1, '<a href="/x">A &amp; B</a><a href="/y">y</a>')], "page_id long, html string")
    got = [(r["link_no"], r["href"], r["label"]) for r in html.anchor_rows(df).orderBy("link_no").collect()]
    assert got == [(1, "/x", "A & B"), (2, "/y", "y")]
