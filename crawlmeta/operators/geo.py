"""Country and language-region classification of sitemap links.

The country-suffix dimension has columns ``ord INT, country_key,
country_name, suffix`` (``ord`` = file order, used for ties). It is a
bounded lookup table (one row per country-code suffix), so the classifier
broadcasts it after checking its size.

Longest-suffix match without a nested-loop join: every host can only match
suffixes that share its last label, so the dimension is grouped by last
label into a candidate list sorted by (-length, ord). A broadcast hash join
on the last label brings at most one list per host; the first candidate
with ``host = suffix-without-dot`` or ``host endswith suffix`` wins. This is
exact for multi-label suffixes too, and needs no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlmeta.functions.text import col, slug, tsv_fields
from crawlmeta.functions.url import last_label, normalize_host, normalize_suffix, url_host, url_path

UNKNOWN_LANGUAGE_REGION = "unknown"

# Locale markers -> language-region. Tokens are searched in the
# order host bigrams, host unigrams, path bigrams, path unigrams.
LANGUAGE_REGION_MARKERS = {
    "uk": "uk-UA", "uk-ua": "uk-UA", "ua": "uk-UA", "ua-uk": "uk-UA",
    "ru": "ru-RU", "ru-ru": "ru-RU",
    "en-gb": "en-GB", "en-uk": "en-GB", "gb": "en-GB",
}

# A sample of the public root-zone country-code table (key,
# name, suffix in the table's own order). The full table is a parameter
# (``load_suffixes`` / ``suffixes_from_root_zone_pages``); this sample covers
# the countries of the bundled corpora.
SAMPLE_COUNTRY_SUFFIXES = [
    ("france", "France", ".fr"),
    ("germany", "Germany", ".de"),
    ("russian-federation", "Russian Federation", ".ru"),
    ("russian-federation", "Russian Federation", ".xn--p1ai"),
    ("ukraine", "Ukraine", ".ua"),
    ("ukraine", "Ukraine", ".xn--j1amh"),
    ("united-kingdom", "United Kingdom", ".gb"),
    ("united-kingdom", "United Kingdom", ".uk"),
]

DIMENSION_SCHEMA = T.StructType([
    T.StructField("ord", T.IntegerType(), False),
    T.StructField("country_key", T.StringType(), False),
    T.StructField("country_name", T.StringType(), False),
    T.StructField("suffix", T.StringType(), False),
])

# A suffix dimension of more bytes than this is joined without a broadcast.
BROADCAST_BYTES = 32 << 20


def dimension_from_rows(spark: SparkSession, rows: list[tuple[str, str, str]]) -> DataFrame:
    """Dimension from (key, name, raw suffix) rows; suffixes normalised."""
    from crawlmeta.session import local_rows
    raw = local_rows(spark, ["ord", "country_key", "country_name", "suffix"],
                     [(i + 1, k, n, s) for i, (k, n, s) in enumerate(rows)],
                     "ord int, country_key string, country_name string, suffix string")
    return raw.withColumn("suffix", normalize_suffix("suffix"))


def sample_dimension(spark: SparkSession) -> DataFrame:
    """The fixed sample dimension, built once per session."""
    dim = getattr(spark, "_crawlmeta_sample_dimension", None)
    if dim is None:
        dim = dimension_from_rows(spark, SAMPLE_COUNTRY_SUFFIXES)
        spark._crawlmeta_sample_dimension = dim
    return dim


def dimension_from_lines(lines: DataFrame, line_col: str = "value", ord_col: str = "line_no") -> DataFrame:
    """Dimension from numbered TSV lines ``(line_no, value)``, line 1 being
    the header; rows need exactly three non-empty fields."""
    f = tsv_fields(line_col)
    ok = (F.size(f) == 3) & (F.try_element_at(f, F.lit(1)) != "") & (F.try_element_at(f, F.lit(2)) != "") & (F.try_element_at(f, F.lit(3)) != "")
    return lines.filter((F.col(ord_col) > 1) & ok).select(
        F.col(ord_col).cast("int").alias("ord"),
        F.try_element_at(f, F.lit(1)).alias("country_key"), F.try_element_at(f, F.lit(2)).alias("country_name"),
        normalize_suffix(F.try_element_at(f, F.lit(3))).alias("suffix"))


def load_suffixes(spark: SparkSession, path: str) -> DataFrame:
    """Read a ``country_key<TAB>country_name<TAB>suffix`` file with a header.
    The file is a small lookup table; line order is kept as ``ord``."""
    lines = spark.read.text(path).coalesce(1).withColumn("line_no", F.monotonically_increasing_id() + 1)
    return dimension_from_lines(lines)


def table_bytes(df: DataFrame) -> int:
    """Bytes of a lookup frame's strings, counted once per frame object."""
    n = getattr(df, "_crawlmeta_bytes", None)
    if n is None:
        size = sum((F.octet_length(F.col(c).cast("string")) for c in df.columns), F.lit(16 * len(df.columns)))
        n = df.agg(F.coalesce(F.sum(size), F.lit(0)).alias("n")).first()["n"]
        df._crawlmeta_bytes = n
    return n


def checked_broadcast(df: DataFrame, size: int) -> DataFrame:
    """Broadcast a lookup side only when its counted bytes are few."""
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def _by_last_label(dim: DataFrame) -> DataFrame:
    bare = F.substr(F.col("suffix"), F.lit(2))
    cand = F.struct((-F.length("suffix")).alias("neg_len"), F.col("ord"), bare.alias("bare"), F.col("suffix"),
                    F.col("country_key"), F.col("country_name"))
    return (dim.select(last_label(bare).alias("label"), cand.alias("c"))
            .groupBy("label").agg(F.array_sort(F.collect_list("c")).alias("cands")))


def best_by_host(hosts: DataFrame, dim: DataFrame) -> DataFrame:
    """(host, best) for distinct hosts and a dimension of any size: a host's
    label suffixes meet the dimension's suffixes in an equi join, and the
    longest (then first listed) match stays."""
    labels = F.split(F.col("host"), "[.]", -1)
    tails = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat(
        F.lit("."), F.array_join(F.slice(labels, i, F.size(labels)), ".")))
    cand = F.struct((-F.length("suffix")).alias("neg_len"), F.col("ord"), F.col("suffix"), F.col("country_key"),
                    F.col("country_name"))
    return (hosts.select("host", F.explode(F.array_distinct(tails)).alias("suffix")).join(dim, "suffix")
            .groupBy("host").agg(F.min(cand).alias("best")))


def _pick(host: Column, cands: Column) -> Column:
    return F.try_element_at(F.filter(cands, lambda c: (host == c["bare"]) | host.endswith(c["suffix"])),
                            F.lit(1))


def locale_tokens(text: Column) -> Column:
    """Bigrams ``a-b`` of adjacent tokens first, then the tokens; tokens are
    runs of [A-Za-z0-9], lowercased. (Reference form of the marker search;
    ``language_region`` uses the equivalent regular expressions.)"""
    toks = F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), "[^A-Za-z0-9]+"), lambda t: F.lower(t)),
                    lambda t: t != "")
    n = F.size(toks)
    bigrams = F.when(n >= 2, F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.concat(
        F.element_at(toks, i), F.lit("-"), F.element_at(toks, i + 1)))).otherwise(F.array().cast("array<string>"))
    return F.concat(bigrams, toks)


def host_without_last_label(host: Column) -> Column:
    """Host text before its last label (trailing dots ignored)."""
    return F.regexp_replace(F.regexp_replace(host, "[.]+$", ""), "[.]?[^.]*$", "")


# Marker search as anchored regular expressions (ASCII case-insensitive):
# the leftmost match is the first marker token in token order.
_B, _A = "(?<![A-Za-z0-9])", "(?![A-Za-z0-9])"
_SEP = "[^A-Za-z0-9]+"
_BIGRAMS = [k.split("-") for k in LANGUAGE_REGION_MARKERS if "-" in k]
_UNIGRAMS = [k for k in LANGUAGE_REGION_MARKERS if "-" not in k]
BIGRAM_MARKER = "(?i)" + _B + "(?:" + "|".join(f"{a}{_SEP}{b}" for a, b in _BIGRAMS) + ")" + _A
UNIGRAM_MARKER = "(?i)" + _B + "(?:" + "|".join(_UNIGRAMS) + ")" + _A


def _marker_region(text: Column, pattern: str, bigram: bool) -> Column:
    hit = F.lower(F.regexp_extract(F.coalesce(text, F.lit("")), pattern, 0))
    key = F.regexp_replace(hit, _SEP, "-") if bigram else hit
    markers = F.create_map(*[x for k, v in LANGUAGE_REGION_MARKERS.items() for x in (F.lit(k), F.lit(v))])
    return F.when(hit != "", F.element_at(markers, key))


def language_region_of(host: Column, path: Column) -> Column:
    """First marker among host tokens (bigrams, then unigrams), then path
    tokens; 'unknown' if none. ``host`` = URL host, ``path`` = raw path."""
    h = host_without_last_label(host)
    return F.coalesce(_marker_region(h, BIGRAM_MARKER, True), _marker_region(h, UNIGRAM_MARKER, False),
                      _marker_region(path, BIGRAM_MARKER, True), _marker_region(path, UNIGRAM_MARKER, False),
                      F.lit(UNKNOWN_LANGUAGE_REGION))


def language_region(url: Column | str) -> Column:
    u = col(url)
    return language_region_of(url_host(u), url_path(u))


CLASS_COLUMNS = ["country_key", "country_name", "matched_suffix", "language_region"]


def classify(df: DataFrame, dim: DataFrame, host_col: str, url_col: str, keep_unmatched: bool = False) -> DataFrame:
    """Add country_key, country_name, matched_suffix, language_region.

    Country comes from the robots host; if that host has no suffix match,
    from the sitemap URL's host. Rows without a country are dropped unless
    ``keep_unmatched`` (then the four columns are NULL)."""
    rh, sh, uh, up = "_cl_rhost", "_cl_shost", "_cl_uhost", "_cl_upath"
    x = (df.withColumn(uh, url_host(url_col)).withColumn(up, url_path(url_col))
         .withColumn(rh, normalize_host(host_col)).withColumn(sh, normalize_host(F.col(uh))))
    if table_bytes(dim) <= BROADCAST_BYTES:
        cands = F.broadcast(_by_last_label(dim))
        r = cands.select(F.col("label").alias("_cl_rlabel"), F.col("cands").alias("_cl_rcands"))
        s = cands.select(F.col("label").alias("_cl_slabel"), F.col("cands").alias("_cl_scands"))
        x = x.join(r, last_label(x[rh]) == r["_cl_rlabel"], "left")
        x = x.join(s, last_label(x[sh]) == s["_cl_slabel"], "left")
        best = F.coalesce(_pick(F.col(rh), F.col("_cl_rcands")), _pick(F.col(sh), F.col("_cl_scands")))
    else:
        hosts = x.select(F.explode(F.array(rh, sh)).alias("host")).where("host IS NOT NULL").distinct()
        by_host = best_by_host(hosts, dim)
        r = by_host.select(F.col("host").alias("_cl_rkey"), F.col("best").alias("_cl_rbest"))
        s = by_host.select(F.col("host").alias("_cl_skey"), F.col("best").alias("_cl_sbest"))
        x = x.join(r, x[rh] == r["_cl_rkey"], "left").join(s, x[sh] == s["_cl_skey"], "left")
        best = F.coalesce("_cl_rbest", "_cl_sbest")
    x = x.withColumn("_cl_best", best)
    if not keep_unmatched:
        x = x.filter(F.col("_cl_best").isNotNull())
    x = x.select(*df.columns,
                 F.col("_cl_best.country_key").alias("country_key"),
                 F.col("_cl_best.country_name").alias("country_name"),
                 F.col("_cl_best.suffix").alias("matched_suffix"),
                 F.when(F.col("_cl_best").isNotNull(), language_region_of(F.col(uh), F.col(up)))
                 .alias("language_region"))
    return x


def select_country(dim: DataFrame, queries: DataFrame, query_col: str = "query") -> DataFrame:
    """For each query text: the first dimension row (file order) whose key or
    name slug equals the query slug, or whose suffix equals the query read
    as a suffix (dot optional). Equi joins on two broadcast lookups; the
    earlier match wins in-row. Unmatched queries get NULLs."""
    by_slug = (dim.select(F.explode(F.array(slug("country_key"), slug("country_name"))).alias("k"),
                          F.struct("ord", "country_key", "country_name").alias("c"))
               .groupBy("k").agg(F.min("c").alias("c")))
    by_suffix = dim.groupBy(F.col("suffix").alias("k")).agg(
        F.min(F.struct("ord", "country_key", "country_name")).alias("c"))
    n = 2 * table_bytes(dim)   # each lookup has at most two keys per dimension row
    a = checked_broadcast(by_slug.select(F.col("k").alias("_sc_k1"), F.col("c").alias("_sc_c1")), n)
    b = checked_broadcast(by_suffix.select(F.col("k").alias("_sc_k2"), F.col("c").alias("_sc_c2")), n)
    probes = queries.withColumn("_sc_slug", slug(query_col)).withColumn("_sc_suffix", normalize_suffix(query_col))
    x = probes.join(a, probes["_sc_slug"] == a["_sc_k1"], "left").join(
        b, probes["_sc_suffix"] == b["_sc_k2"], "left")
    best = F.least(F.col("_sc_c1"), F.col("_sc_c2"))
    return x.select(*queries.columns, best["country_key"].alias("country_key"),
                    best["country_name"].alias("country_name"))


def country_dimension(dim: DataFrame, country_key: str) -> DataFrame:
    """Dimension restricted to one country (applied before classification)."""
    return dim.filter(F.col("country_key") == country_key).dropDuplicates(["country_key", "country_name", "suffix"])


def supported_country_keys(dim: DataFrame, n: int = 12) -> DataFrame:
    """The first ``n`` distinct keys in sorted order (shown in errors)."""
    return dim.select("country_key").distinct().orderBy("country_key").limit(n)


def resolve_country(spark: SparkSession, dim: DataFrame, query: str) -> str:
    """Country key for one query text (key, name or suffix). An unknown
    country is an error that lists the first supported keys, raised before
    any job over the data runs."""
    from crawlmeta.session import local_rows
    q = local_rows(spark, ["query"], [(query,)], "query string")
    row = select_country(dim, q).first()
    if row is None or row["country_key"] is None:
        keys = [r["country_key"] for r in supported_country_keys(dim).collect()]
        raise ValueError(f"Unknown sitemap country '{query}'. Supported country keys include: {', '.join(keys)}")
    return row["country_key"]
