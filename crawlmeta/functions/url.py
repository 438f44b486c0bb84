"""URL and host column helpers.

Spark's ``parse_url`` is backed by ``java.net.URI``, so host and path
extraction follow the same RFC 2396 parser the crawl tools use (hosts
with ``_`` or non-ASCII text have no host, for example). ``try_parse_url``
gives NULL on a syntax error instead of raising under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from crawlmeta.functions.text import col, java_trim


def try_parse_url(c: Column | str, part: str) -> Column:
    return F.try_parse_url(col(c), F.lit(part))


def url_host(u: Column | str) -> Column:
    """Host of a URL; when the text has none, retry with ``https://`` put in
    front (so ``example.ua/x`` gives ``example.ua``).

    ``java.net.URI`` has no host for names with ``_`` or non-ASCII text, so
    the retry then yields ``https`` (kept, as the crawl tools do)."""
    u = col(u)
    return F.coalesce(
        try_parse_url(java_trim(u), "HOST"),
        try_parse_url(java_trim(F.concat(F.lit("https://"), u)), "HOST"),
    )


def url_path(u: Column | str) -> Column:
    """Raw path; a scheme-less text is all path."""
    return try_parse_url(java_trim(u), "PATH")


def is_ascii(c: Column | str) -> Column:
    return col(c).rlike("^[\\x00-\\x7f]*$")


def normalize_host(h: Column | str) -> Column:
    """Trim, drop one trailing dot, IDN to ASCII (unassigned code points
    allowed; on failure keep the text), lowercase. ASCII text is unchanged
    by the IDN step, so only non-ASCII hosts call into ``java.net.IDN``."""
    h0 = F.regexp_replace(java_trim(h), "[.]$", "")
    ascii_form = F.when(is_ascii(h0), h0).otherwise(
        F.coalesce(F.try_reflect(F.lit("java.net.IDN"), F.lit("toASCII"), h0, F.lit(1)), h0))
    return F.lower(ascii_form)


def normalize_suffix(s: Column | str) -> Column:
    """Trim, drop one leading dot, normalise as a host, put one dot back."""
    bare = F.regexp_replace(java_trim(s), "^[.]", "")
    return F.concat(F.lit("."), normalize_host(bare))


def last_label(h: Column | str) -> Column:
    return F.substring_index(col(h), ".", -1)


def is_robots_target(u: Column | str) -> Column:
    """URI path, lowercased, ends with ``/robots.txt``; bad URI = false.
    The path is compared decoded, as ``URI.getPath`` gives it."""
    raw = try_parse_url(u, "PATH")
    decoded = F.when(raw.contains("%"), F.try_url_decode(F.replace(raw, F.lit("+"), F.lit("%2B")))).otherwise(raw)
    return F.coalesce(F.lower(decoded).endswith("/robots.txt"), F.lit(False))


def is_usable_sitemap_value(v: Column | str) -> Column:
    """Non-empty, no whitespace (``Character.isWhitespace``), and starts
    with ``http://`` / ``https://`` (any case) or ``/`` (covers ``//``)."""
    v = col(v)
    return (v != "") & ~v.rlike("\\p{javaWhitespace}") & v.rlike("^(?i:https?://|/)")


def archive_uri(p: Column | str, base: str = "https://data.commoncrawl.org/") -> Column:
    """Absolute archive paths are kept; relative ones are resolved on the
    public crawl bucket base."""
    p = col(p)
    return F.when(p.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), p).otherwise(
        F.concat(F.lit(base), F.regexp_replace(p, "^/+", "")))


def manifest_url(u: Column | str) -> Column:
    """A ``…/wat.paths.gz`` manifest URL points at ``…/robotstxt.paths.gz``."""
    return F.regexp_replace(col(u), "/wat[.]paths[.]gz$", "/robotstxt.paths.gz")
