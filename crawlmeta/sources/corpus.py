"""Corpora derived from the given tables.

The given tables hold no robots.txt captures or sitemap files, so these
transforms derive them from ``pages`` (``page_id, url, html``): corpus A is
one robots capture per page, corpus B one sitemap index plus one sitemap
document per page. The construction rule (which case a page gets) is a
function of ``page_id``; every row of the input is used, so the corpora
grow with the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlmeta.functions.text import BOM

# The eight robots bodies of corpus A (case = page_id % 8),
# the country code a page host gets (page_id % 7) and the sitemap folder
# (page_id % 5). ``{s}`` = scheme, ``{h}`` = host, ``{loc}`` = folder.
_ROBOTS_CASES = r"""
case page_id % 8
  when 0 then concat('User-agent: *', char(10), 'Disallow: /cart/ # no shop pages', char(10), 'Crawl-delay: soon', char(10), 'Sitemap: ', scheme, '://', host, '/', loc, 'sitemap.xml', char(10))
  when 1 then concat('Sitemap: ', scheme, '://', host, '/', loc, 'sitemap.xml', char(13), char(10), 'sitemap:/sitemap.xml', char(13), char(10))
  when 2 then concat('{BOM}', 'User-agent: A', char(10), 'user-agent: b', char(10), 'Allow: /', char(10), 'Crawl-delay: 2.5', char(10), 'Request-rate: 1/10', char(10), 'User-agent: c', char(10), 'Disallow:', char(10))
  when 3 then concat('<!doctype html>', char(10), '<p>Page ', cast(page_id as string), ' is gone</p>', char(10))
  when 4 then concat('Allow: /too-soon', char(10), 'User-agent: *', char(10), 'Sitemap: see the map page', char(10), 'Sitemap: https://maps.example.ua/', loc, 'all.xml', char(10), 'Disallow: /old', char(10))
  when 5 then concat('User-agent:', char(10), 'Request-rate: 0/5', char(10), 'no colon here', char(10))
  when 6 then concat('User-agent: *', char(13), 'Sitemap: ', scheme, '://', host, '/a.xml', char(13), 'Sitemap: ', scheme, '://', host, '/a.xml', char(13), 'Host: x')
  else '' end
""".replace("{BOM}", BOM)

_COUNTRY_CODE = ("case page_id % 7 when 0 then 'ua' when 1 then 'uk' when 2 then 'ru' when 3 then 'de' "
                 "when 4 then 'xn--j1amh' when 5 then 'fr' else 'com' end")
_LOC = "case page_id % 5 when 0 then 'uk-ua/' when 1 then 'ru/' when 2 then 'en-gb/' when 3 then 'en/gb/' else '' end"


def robots_captures(pages: DataFrame) -> DataFrame:
    """Corpus A: ``(page_id, robots_url, robots_host, body)``, one per page."""
    p = pages.select(
        "page_id",
        F.regexp_extract("url", "^https?://([^/?#]+)", 1).alias("h"),
        F.regexp_extract("url", "^(https?)://", 1).alias("scheme"),
        F.expr(_COUNTRY_CODE).alias("cc"), F.expr(_LOC).alias("loc"))
    q = p.select("page_id", "scheme", "loc",
                 F.regexp_replace("h", "[.](com|net|org)$", F.concat(F.lit("."), F.col("cc"))).alias("host"))
    return q.select("page_id",
                    F.concat("scheme", F.lit("://"), "host", F.lit("/robots.txt")).alias("robots_url"),
                    F.col("host").alias("robots_host"),
                    F.expr(_ROBOTS_CASES).alias("body"))


def _next_index_id() -> str:
    return ("case when page_id < 25 then (case when page_id % 5 < 4 then page_id + 1 else page_id - 4 end) "
            "when page_id % 30 < 29 then page_id + 1 else page_id - 29 end")


_SITEMAP_BODY = r"""
case page_id % 6
  when 0 then concat('<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"><url><loc>', replace(url, '&', '&amp;'), '</loc><i:image xmlns:i="http://x.example/i"><i:loc>https://x.example/i.jpg</i:loc></i:image></url><url><loc>/p/', cast(page_id as string), '</loc></url><url><loc>mailto:a@example.ua</loc></url></urlset>')
  when 1 then concat('<rss version="2.0"><channel><link>https://x.example/</link><item><link>', replace(url, '&', '&amp;'), '</link></item></channel></rss>')
  when 2 then concat('<feed xmlns="http://www.w3.org/2005/Atom"><link href="https://x.example/"/><entry><link href="', replace(url, '&', '&amp;'), '"/><link rel="self" href="https://x.example/self"/></entry></feed>')
  when 3 then concat(url, char(10), url, char(10))
  when 4 then '<html><body>not a sitemap</body></html>'
  else concat(url, char(10), 'not a url', char(10)) end
"""


def sitemap_documents(pages: DataFrame) -> DataFrame:
    """Corpus B: ``(url, body)``; per page one sitemap index ``idx-N.xml``
    (its own ``sm-N.xml`` relative, plus one next index) and one document
    ``sm-N.xml`` (urlset / RSS / Atom / text / HTML / bad text)."""
    page = F.col("page_id").cast("string")
    index = F.concat(F.lit('<?xml version="1.0"?><sitemapindex xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'),
                     F.lit("<sitemap><loc> sm-"), page, F.lit(".xml </loc></sitemap>"),
                     F.lit("<sitemap><loc>https://s.example.ua/idx-"), F.expr(_next_index_id()).cast("string"),
                     F.lit(".xml</loc></sitemap>"), F.lit("</sitemapindex>"))
    both = [F.struct(F.concat(F.lit(f"https://s.example.ua/{name}-"), page, F.lit(".xml")).alias("url"), body.alias("body"))
            for name, body in (("idx", index), ("sm", F.expr(_SITEMAP_BODY)))]
    return pages.select(F.inline(F.array(*both)))


def sitemap_seeds(pages: DataFrame) -> DataFrame:
    """Seeds of corpus B: every index URL, ``seed_id`` = page_id."""
    return pages.select(
        F.col("page_id").alias("seed_id"),
        F.concat(F.lit("https://s.example.ua/idx-"), F.col("page_id").cast("string"), F.lit(".xml"))
        .alias("seed_sitemap_url"))


def archive_path(page_id_col: str = "page_id", per_archive: int = 10) -> F.Column:
    """Archive a capture belongs to: ``per_archive`` consecutive pages share
    one robots WARC archive path (relative, as crawl manifests list them)."""
    seg = F.floor(F.col(page_id_col) / per_archive).cast("long")
    return F.concat(F.lit("crawl-data/CC-MAIN-2024-33/segments/"), seg.cast("string"),
                    F.lit("/robotstxt/CC-MAIN-"), F.lpad(seg.cast("string"), 5, "0"), F.lit(".warc.gz"))


def capture_date(page_id_col: str = "page_id") -> F.Column:
    """ISO-8601 capture instant derived from the page id (seconds offset)."""
    # TIMESTAMP_NTZ arithmetic: the text does not depend on the session time zone
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    ts = F.timestamp_add("SECOND", F.lit(1722470400) + F.col(page_id_col) * 37, epoch)
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def lineitem_pages(lineitem: DataFrame) -> DataFrame:
    """A ``(page_id, url)`` key table over ``lineitem``: one page per
    distinct (l_orderkey, l_linenumber) key (the table repeats some keys),
    so robots corpora grow with the fact table. Host and path come from the
    key alone."""
    keys = lineitem.select("l_orderkey", "l_linenumber").distinct()
    pid = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    tld = F.element_at(F.array(F.lit("com"), F.lit("net"), F.lit("org")), (F.col("l_orderkey") % 3 + 1).cast("int"))
    url = F.concat(F.when(F.col("l_linenumber") % 2 == 0, F.lit("https")).otherwise(F.lit("http")), F.lit("://s"),
                   (F.col("l_orderkey") % 997).cast("string"), F.lit(".example."), tld, F.lit("/p/"),
                   F.col("l_orderkey").cast("string"))
    return keys.select(pid.alias("page_id"), url.alias("url"))
