"""HTML text helpers with built-in expressions.

``html_unescape`` decodes entities in one left-to-right pass (so
``&amp;lt;`` becomes ``&lt;``, not ``<``): the text is split at entity
matches, every match is decoded on its own, and the pieces are joined
back with ``aggregate``. Unknown names, invalid code points and numbers
that overflow an int are kept as written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlmeta.functions.text import col, java_trim, slug

# Entity pattern and the named entities that are decoded.
ENTITY_PATTERN = r"&(#x[0-9A-Fa-f]+|#[0-9]+|[A-Za-z]+);"
NAMED_ENTITIES = {"amp": "&", "apos": "'", "gt": ">", "lt": "<", "nbsp": " ", "quot": '"'}

# Root-zone database page patterns (index row: href, label,
# type; detail page: country designation comment).
ROOT_ZONE_ROW_PATTERN = (r'<tr>\s*<td>\s*<span class="domain tld"><a href="([^"]+)">\.([^<]+)</a></span></td>'
                         r"\s*<td>([^<]+)</td>")
ROOT_ZONE_COUNTRY_PATTERN = r"<!-- \(Country-code top-level domain designated for (.*?)\) -->"
COUNTRY_CODE_TYPE = "country-code"


def _code_point_char(code: Column) -> Column:
    """Character for a code point (as BIGINT), NULL when not a valid one."""
    utf32 = F.unhex(F.lpad(F.hex(code), 8, "0"))
    ok = code.isNotNull() & (code >= 0) & (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    return F.when(ok, F.decode(utf32, "UTF-32"))


def _decode_entity(e: Column) -> Column:
    named = F.element_at(F.create_map(*[x for k, v in NAMED_ENTITIES.items() for x in (F.lit(k), F.lit(v))]), e)
    hex_digits = F.substr(e, F.lit(3))
    dec_digits = F.substr(e, F.lit(2))
    hex_code = F.when(F.length(F.ltrim(F.lit("0"), hex_digits)) <= 8,
                      F.conv(hex_digits, 16, 10).cast("long"))
    dec_code = F.when(F.length(F.ltrim(F.lit("0"), dec_digits)) <= 10, dec_digits.cast("decimal(12,0)").cast("long"))
    code = F.when(e.startswith("#x"), hex_code).when(e.startswith("#"), dec_code)
    code = F.when(code <= 2147483647, code)
    numeric = F.when(e.startswith("#"), _code_point_char(code))
    return F.coalesce(F.when(~e.startswith("#"), named), numeric, F.concat(F.lit("&"), e, F.lit(";")))


def html_unescape(c: Column | str) -> Column:
    text = col(c)
    pieces = F.split(text, ENTITY_PATTERN, -1)
    ents = F.regexp_extract_all(text, F.lit(ENTITY_PATTERN), 1)
    joined = F.aggregate(F.sequence(F.lit(1), F.size(ents)), F.element_at(pieces, 1),
                         lambda acc, i: F.concat(acc, _decode_entity(F.element_at(ents, i)),
                                                 F.element_at(pieces, i + 1)))
    return F.when(F.size(ents) == 0, text).otherwise(joined)


def anchor_rows(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """One row per ``<a href="...">label</a>``: key, link_no, href, label (decoded)."""
    pat = r'<a href="([^"]*)">([^<]*)</a>'
    x = pages.select(key, F.arrays_zip(F.regexp_extract_all(html, F.lit(pat), 1).alias("href"),
                                       F.regexp_extract_all(html, F.lit(pat), 2).alias("label")).alias("_z"))
    x = x.select(key, F.posexplode("_z").alias("_pos", "_a"))
    return x.select(key, (F.col("_pos") + 1).cast("long").alias("link_no"), F.col("_a.href").alias("href"),
                    html_unescape(F.col("_a.label")).alias("label"))


def suffixes_from_root_zone_pages(index_pages: DataFrame, detail_pages: DataFrame) -> DataFrame:
    """Country-suffix rows from root-zone database pages.

    ``index_pages(html)``: index rows (href, label, type) -> keep type
    ``country-code``; ``detail_pages(href, html)``: the page each href points
    at, giving the country name. Result ``country_key, country_name, suffix``
    distinct, ordered by key then suffix (the dimension file's order)."""
    z = F.arrays_zip(F.regexp_extract_all("html", F.lit(ROOT_ZONE_ROW_PATTERN), 1).alias("href"),
                     F.regexp_extract_all("html", F.lit(ROOT_ZONE_ROW_PATTERN), 3).alias("typ"))
    rows = index_pages.select(F.explode(z).alias("_r")).select(
        F.col("_r.href").alias("href"), java_trim(html_unescape(F.col("_r.typ"))).alias("typ"))
    cc = rows.filter(F.col("typ") == COUNTRY_CODE_TYPE)
    tld_id = F.lower(F.regexp_replace(F.element_at(F.split("href", "/"), -1), "[.]html$", ""))
    cc = cc.select("href", tld_id.alias("tld_id"))
    names = detail_pages.select(F.col("href").alias("_href"), java_trim(html_unescape(
        F.regexp_extract("html", ROOT_ZONE_COUNTRY_PATTERN, 1))).alias("country_name"))
    joined = cc.join(names, cc["href"] == names["_href"], "inner")
    out = joined.select(slug("country_name").alias("country_key"), "country_name",
                        F.concat(F.lit("."), F.col("tld_id")).alias("suffix")).distinct()
    return out.orderBy("country_key", "suffix")
