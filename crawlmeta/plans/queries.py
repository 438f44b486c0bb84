"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

They read the given parquet tables (``pages`` and friends), derive the crawl
corpora from them with Spark, and run the library's transforms over the
whole input. Column names match the DuckDB oracle texts in
``oracles/sql.py``.
"""

from __future__ import annotations

import gzip
import uuid

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlmeta.functions import html as html_fn
from crawlmeta.functions import policy
from crawlmeta.functions.resolve import with_resolved
from crawlmeta.functions.text import tsv_row
from crawlmeta.functions.url import normalize_host
from crawlmeta.operators import crawl as crawl_op
from crawlmeta.operators import geo, quality, robots
from crawlmeta.operators.metrics import archive_results
from crawlmeta.operators.sitemap_docs import parse_sitemaps
from crawlmeta.operators.sitemap_rows import location_rows
from crawlmeta.session import checkpoint_dir, ship_package, work_folder
from crawlmeta.sinks import robots_files, snapshots
from crawlmeta.sinks import tsv as tsv_sink
from crawlmeta.sinks.robots_files import archive_file_name, robots_file_name
from crawlmeta.plans import jobs
from crawlmeta.sources import corpus, fetch, local_tree, manifest, tsv, warc, warc_index
from crawlmeta.sources.files import open_output
from crawlmeta.streaming import pipelines as streams
from crawlmeta.streaming.ledger import Ledger, file_target

# Crawler names checked against robots groups.
AGENTS = ["Googlebot", "Bingbot", "a-crawler/1.0", "B", "CCBot/2.0"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.robots_captures(table(spark, sf_dir, "pages").select("page_id", "url"))


def parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return robots.with_robots(captures(spark, sf_dir))


def sitemap_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct sitemap URLs of valid captures: page_id, robots_host, sitemap_url."""
    p = robots.with_sitemaps(captures(spark, sf_dir))
    return robots.sitemap_rows(p, ["page_id", "robots_url", "robots_host"]).drop("sitemap_no")


def classified(spark: SparkSession, sf_dir: str, dim: DataFrame | None = None) -> DataFrame:
    links = sitemap_links(spark, sf_dir)
    return geo.classify(links, dim if dim is not None else geo.sample_dimension(spark),
                        "robots_host", "sitemap_url")


# --- robots.txt -------------------------------------------------------------

def q_robots_directives(spark, sf_dir):
    return robots.directive_rows(captures(spark, sf_dir), ["page_id"])


def q_robots_groups(spark, sf_dir):
    return robots.group_rows(parsed(spark, sf_dir), ["page_id"])


def q_robots_rules(spark, sf_dir):
    return robots.rule_rows(parsed(spark, sf_dir), ["page_id"])


def q_robots_sitemaps(spark, sf_dir):
    return robots.sitemap_rows(parsed(spark, sf_dir), ["page_id"])


def q_robots_warnings(spark, sf_dir):
    return robots.warning_rows(parsed(spark, sf_dir), ["page_id"])


def q_robots_valid_counts(spark, sf_dir):
    """Per archive: parsed (valid) and rejected captures, distinct links."""
    return archive_results(parsed(spark, sf_dir).withColumn("archive_path", corpus.archive_path()))


def q_robots_groups_for_agent(spark, sf_dir):
    return robots.agent_group_rows(parsed(spark, sf_dir), ["page_id"], AGENTS)


# --- classification ---------------------------------------------------------

def q_sitemaps_classified(spark, sf_dir):
    return classified(spark, sf_dir).select(
        "page_id", "robots_host", "sitemap_url", "country_key", "country_name", "matched_suffix",
        "language_region")


def q_sitemap_language_region(spark, sf_dir):
    """Language-region of every distinct sitemap link (matched or not)."""
    links = sitemap_links(spark, sf_dir)
    return links.select("page_id", "sitemap_url", geo.language_region("sitemap_url").alias("language_region"))


def q_sitemap_country_counts(spark, sf_dir):
    """Flagship: links per (country, language-region)."""
    return classified(spark, sf_dir).groupBy("country_key", "language_region").agg(
        F.count(F.lit(1)).alias("links"))


QUERIES = {
    "robots_directives": q_robots_directives,
    "robots_groups": q_robots_groups,
    "robots_rules": q_robots_rules,
    "robots_sitemaps": q_robots_sitemaps,
    "robots_warnings": q_robots_warnings,
    "robots_valid_counts": q_robots_valid_counts,
    "robots_groups_for_agent": q_robots_groups_for_agent,
    "sitemaps_classified": q_sitemaps_classified,
    "sitemap_language_region": q_sitemap_language_region,
    "sitemap_country_counts": q_sitemap_country_counts,
}


# --- grouping, one-country mode, country selection ----------------------------


def q_filter_grouped(spark, sf_dir):
    """Every classified link under its country and its language-region."""
    c = classified(spark, sf_dir)
    return tsv_sink.grouped_rows(c).select("out_group", "out_key", "page_id", "sitemap_url")


def q_one_country_sitemaps(spark, sf_dir, country: str = "ua"):
    """One-country mode: the dimension is cut to the country *before* the
    lookup, so a .de robots host with a .ua sitemap counts as this country."""
    dim = geo.sample_dimension(spark)
    one = geo.country_dimension(dim, geo.resolve_country(spark, dim, country))
    return classified(spark, sf_dir, one).select(
        "page_id", "robots_host", "sitemap_url", "country_key", "country_name", "matched_suffix",
        "language_region")


# Country query texts, picked per page as page_id % 8.
COUNTRY_QUERIES = ["Ukraine", " united KINGDOM ", ".UA", "ua", "XN--P1AI", "russia", "Russian Federation!", "de"]


def q_select_country(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id")
    texts = F.array(*[F.lit(t) for t in COUNTRY_QUERIES])
    qs = pages.select("page_id", F.element_at(texts, (F.col("page_id") % len(COUNTRY_QUERIES) + 1).cast("int"))
                      .alias("query"))
    return geo.select_country(geo.sample_dimension(spark), qs)


# IDN top-level labels given to page hosts (page_id % 4).
IDN_TLDS = ["укр", "рф", "УКР.", "ua"]


def q_idn_hosts(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    tld = F.element_at(F.array(*[F.lit(t) for t in IDN_TLDS]), (F.col("page_id") % len(IDN_TLDS) + 1).cast("int"))
    sld = F.regexp_replace(F.regexp_extract("url", "^https?://([^/?#]+)", 1), "[.](com|net|org)$", "")
    hosts = pages.select("page_id", F.concat(sld, F.lit("."), tld).alias("host"))
    out = hosts.withColumn("ascii_host", normalize_host("host"))
    with_country = geo.classify(out.withColumn("_url", F.lit("")), geo.sample_dimension(spark), "host", "_url",
                                keep_unmatched=True)
    return with_country.select("page_id", "host", "ascii_host", "country_key")


# --- manifest, file names, TSV rows, fetch policy, JSON payload -----------------

def manifest_lines_from_pages(pages: DataFrame) -> DataFrame:
    """A manifest text derived from pages: robots archives (padded with
    spaces), comments, blank lines, non-robots archives and absolute URLs."""
    pid = F.col("page_id").cast("string")
    value = (F.when(F.col("page_id") % 5 == 0, F.concat(F.lit("  crawl-data/CC-MAIN-2024-33/segments/"), pid,
                                                          F.lit("/robotstxt/CC-MAIN-"), pid, F.lit(".warc.gz  ")))
             .when(F.col("page_id") % 5 == 1, F.concat(F.lit("# comment "), pid))
             .when(F.col("page_id") % 5 == 2, F.lit(""))
             .when(F.col("page_id") % 5 == 3, F.concat(F.lit("crawl-data/CC-MAIN-2024-33/segments/"), pid,
                                                       F.lit("/wat/CC-MAIN-"), pid, F.lit(".warc.wat.gz")))
             .otherwise(F.concat(F.lit("https://data.commoncrawl.org/crawl-data/x/"), pid,
                                 F.lit("/robotstxt/r.warc.gz"))))
    return pages.select(F.col("page_id").alias("line_no"), value.alias("value"))


MANIFEST_SKIP, MANIFEST_MAX = 3, 40


def q_manifest_slice(spark, sf_dir):
    lines = manifest_lines_from_pages(table(spark, sf_dir, "pages").select("page_id"))
    sliced = manifest.slice_archives(manifest.archive_paths(lines), MANIFEST_SKIP, MANIFEST_MAX)
    return manifest.with_archive_uri(sliced).select(F.col("line_no").cast("long").alias("line_no"),
                                                    "archive_path", "archive_uri")


def q_capture_file_names(spark, sf_dir):
    c = captures(spark, sf_dir).select("page_id", "robots_url", corpus.capture_date().alias("capture_date"),
                                       corpus.archive_path().alias("archive_path"))
    return c.select("page_id", robots_file_name("robots_url", "capture_date", "archive_path").alias("file_name"))


def q_archive_names(spark, sf_dir):
    a = table(spark, sf_dir, "pages").select(corpus.archive_path().alias("archive_path")).distinct()
    return a.select("archive_path", archive_file_name("archive_path").alias("file_name"))


def tsv_lines_from_links(links: DataFrame) -> DataFrame:
    """Local sitemap TSV lines with injected bad shapes (page_id % 6):
    good, 3 fields, 5 fields, empty host, 8 fields, empty sitemap URL."""
    path = F.concat(F.lit("/data/robots/"), F.col("robots_host"), F.lit("/https-"),
                    F.col("page_id").cast("string"), F.lit(".txt"))
    h, s, u = F.col("robots_host"), F.lit("https"), F.col("sitemap_url")
    k = F.col("page_id") % 6
    line = (F.when(k == 0, tsv_row(path, h, s, u))
            .when(k == 1, tsv_row(path, h, u))
            .when(k == 2, tsv_row(path, h, s, u, F.lit("extra")))
            .when(k == 3, tsv_row(path, F.lit(""), s, u))
            .when(k == 4, tsv_row(path, h, s, u, F.lit("ukraine"), F.lit("Ukraine"), F.lit(".ua"), F.lit("uk-UA")))
            .otherwise(tsv_row(path, h, s, F.lit(""))))
    return links.select("page_id", "sitemap_no", line.alias("value"))


def q_tsv_rows(spark, sf_dir):
    links = robots.sitemap_rows(parsed(spark, sf_dir), ["page_id", "robots_host"])
    lines = tsv_lines_from_links(links)
    strict = tsv.parse_local_sitemap_rows(lines)
    seeds = tsv.parse_seed_rows(strict.select("page_id", "sitemap_no", "value", F.col("status").alias("strict_status"),
                                              *tsv.LOCAL_SITEMAP_COLUMNS))
    both = tsv.parse_link_rows(seeds.withColumnRenamed("status", "seed_status"))
    return both.select("page_id", "sitemap_no", "strict_status", "seed_status",
                       F.col("status").alias("link_status"), "robots_host", "sitemap_url", "seed_sitemap_url",
                       "page_url")


def q_tsv_encode(spark, sf_dir):
    """Capture rows as TSV lines (bodies carry TAB/CR/LF that become spaces)."""
    c = captures(spark, sf_dir)
    return c.select("page_id", tsv_row("robots_url", "robots_host", "body").alias("line"))


# HTTP statuses (page_id % 10) and download hosts (page_id % 3).
POLICY_STATUSES = [200, 403, 404, 408, 425, 429, 500, 502, 503, 504]


def q_fetch_policy(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    pid = F.col("page_id")
    url = (F.when(pid % 3 == 0, F.col("url"))
           .when(pid % 3 == 1, F.concat(F.lit("https://data.commoncrawl.org/crawl-data/"), pid.cast("string"),
                                        F.lit(".warc.gz")))
           .otherwise(F.concat(F.lit("https://DS5Q9OXWQWSFJ.cloudfront.net/"), pid.cast("string"))))
    status = F.when(pid % 11 == 10, F.lit(None).cast("int")).otherwise(
        F.element_at(F.array(*[F.lit(s) for s in POLICY_STATUSES]), (pid % 10 + 1).cast("int")))
    g = pages.select("page_id", url.alias("url"), status.alias("status"),
                     (pid % 6 + 1).cast("int").alias("attempt"))
    return g.select("page_id", "url", F.col("status").cast("long").alias("status"),
                    F.col("attempt").cast("long").alias("attempt"),
                    policy.max_attempts("url").cast("long").alias("max_attempts"),
                    policy.retryable("url", "status").alias("retryable"),
                    policy.backoff_ms("url", "attempt").alias("backoff_ms"),
                    policy.will_retry("url", "status", "attempt").alias("will_retry"))


def q_kafka_payload(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return pages.select("page_id", F.to_json(F.struct(F.col("url").alias("url"))).alias("value"))


QUERIES.update({
    "filter_grouped": q_filter_grouped,
    "one_country_sitemaps": q_one_country_sitemaps,
    "select_country": q_select_country,
    "idn_hosts": q_idn_hosts,
    "manifest_slice": q_manifest_slice,
    "capture_file_names": q_capture_file_names,
    "archive_names": q_archive_names,
    "tsv_rows": q_tsv_rows,
    "tsv_encode": q_tsv_encode,
    "fetch_policy": q_fetch_policy,
    "kafka_payload": q_kafka_payload,
})


# --- sitemap documents, loc resolution, sitemap-index crawl ----------------------


def documents_b(spark, sf_dir):
    return corpus.sitemap_documents(table(spark, sf_dir, "pages").select("page_id", "url"))


def q_sitemap_docs(spark, sf_dir):
    d = parse_sitemaps(documents_b(spark, sf_dir))
    return d.select("url", F.col("doc.kind").alias("kind"), F.array_join("doc.locs", " ").alias("locs"),
                    F.col("doc.error").alias("error"))


def q_sitemap_location_rows(spark, sf_dir):
    """The documents as rows of URLs, as the crawl reads them."""
    return location_rows(documents_b(spark, sf_dir)).select("url", "kind", "error", F.col("loc_no").cast("long").alias("loc_no"), "loc")


# References resolved against every page URL besides its own
# links (directory query, empty, above-root, scheme case and double slash,
# network path, opaque, space, dot segments).
EXTRA_REFS = ["?a=1", "", "../../x", "HTTP://Example.UA/a//b", "//cdn.example.ua/x", "mailto:a@b", "a b",
              "x/./y/../z"]


def q_resolve_loc(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    hrefs = F.regexp_extract_all("html", F.lit('href="([^"]*)"'), 1)
    refs = F.concat(hrefs, F.array(*[F.lit(r) for r in EXTRA_REFS]))
    x = pages.select("page_id", F.col("url").alias("base"), F.posexplode(refs).alias("ref_no", "ref"))
    return with_resolved(x, "base", "ref", "resolved").select(
        "page_id", F.col("ref_no").cast("long").alias("ref_no"), "ref", "resolved")


def _crawl(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    seeds = corpus.sitemap_seeds(pages)
    fetch = crawl_op.table_fetcher(corpus.sitemap_documents(pages))
    return seeds, crawl_op.crawl(seeds, fetch)


def q_crawl_links(spark, sf_dir):
    _, res = _crawl(spark, sf_dir)
    return res.links.select("seed_id", "sitemap_url", "page_url")


def q_crawl_counters(spark, sf_dir):
    seeds, res = _crawl(spark, sf_dir)
    return crawl_op.seed_counters(res, seeds)


QUERIES.update({
    "sitemap_docs": q_sitemap_docs,
    "sitemap_location_rows": q_sitemap_location_rows,
    "resolve_loc": q_resolve_loc,
    "crawl_links": q_crawl_links,
    "crawl_counters": q_crawl_counters,
})


# --- HTML rows -------------------------------------------------------------------


def q_html_rows(spark, sf_dir):
    """Anchor rows of every page plus its decoded title."""
    pages = table(spark, sf_dir, "pages").select("page_id", "html")
    links = html_fn.anchor_rows(pages)
    titles = pages.select("page_id", F.lit(0).cast("long").alias("link_no"), F.lit(None).cast("string").alias("href"),
                          html_fn.html_unescape(F.regexp_extract("html", "<title>([^<]*)</title>", 1)).alias("label"))
    return links.unionByName(titles)


QUERIES["html_rows"] = q_html_rows


# --- WARC round trip ---------------------------------------------------------------


# Content-Encoding per capture (page_id % 4).
WARC_ENCODINGS = ["", "gzip", "deflate", "deflate, gzip"]


def q_warc_roundtrip(spark, sf_dir):
    """Corpus A written as WARC archives (with noise records and stacked
    encodings), read back with the WARC source, decoded and parsed."""
    c = captures(spark, sf_dir)
    enc = F.element_at(F.array(*[F.lit(e) for e in WARC_ENCODINGS]), (F.col("page_id") % 4 + 1).cast("int"))
    rows = c.select(F.floor(F.col("page_id") / 10).cast("long").cast("string").alias("archive_key"),
                    F.col("robots_url").alias("target_url"), corpus.capture_date().alias("capture_date"),
                    "body", enc.alias("content_encoding"))
    out_dir = f"{checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    warc.write_warc_files(rows, out_dir).write.format("noop").mode("overwrite").save()
    got = warc.read_warc(spark, out_dir)
    parsed_back = robots.with_robots(got.withColumn("text", robots.decode_body("body")), body="text")
    return parsed_back.select("target_url", "capture_date", "content_encoding", F.col("text").alias("body"),
                              F.col("robots.valid").alias("valid"),
                              F.size(F.array_distinct("robots.sitemaps")).cast("long").alias("sitemap_links"))


QUERIES["warc_roundtrip"] = q_warc_roundtrip


def q_warc_split_roundtrip(spark, sf_dir):
    """Corpus A as two archives, indexed by ranges of a 64th each; robots captures read by range,
    and once more those of one host ending, which skips the other members."""
    rows = _capture_rows(spark, sf_dir).withColumn("archive_key", (F.col("page_id") % 2).cast("string"))
    base = work_folder(spark, "warc-split")
    files = warc_index.archive_files(_archived(spark, rows, f"{base}/in"))
    step = max(1, sum(size for _, _, size in files) // 64)
    index = warc_index.build_index(spark, files, f"{base}/index", range_bytes=step)
    got = warc_index.read_indexed(index, range_bytes=step).withColumn("selected", F.lit("all"))
    some = warc_index.read_indexed(index, where="target_url LIKE '%.ua/robots.txt'").withColumn("selected", F.lit("ua"))
    return got.unionByName(some).select("selected", "target_url", "capture_date", "content_encoding",
                                        robots.decode_body("body").alias("body"), "error")


QUERIES["warc_split_roundtrip"] = q_warc_split_roundtrip


# --- streaming = batch -------------------------------------------------------------


def local_sitemap_lines(spark, sf_dir) -> DataFrame:
    """Corpus A links as local sitemap TSV lines (file path, host, scheme, URL)."""
    links = robots.sitemap_rows(robots.with_sitemaps(captures(spark, sf_dir)), ["page_id", "robots_host"])
    path = F.concat(F.lit("/data/robots/"), F.col("robots_host"), F.lit("/https-"),
                    F.col("page_id").cast("string"), F.lit(".txt"))
    return links.select("page_id", tsv_row(path, "robots_host", F.lit("https"), "sitemap_url").alias("value"))


def q_stream_equals_batch(spark, sf_dir):
    """Corpus A link TSVs -> the streaming filter job (available-now) -> the
    grouped output read back; equals the batch classification."""
    base = f"{checkpoint_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    local_sitemap_lines(spark, sf_dir).select(F.floor(F.col("page_id") / 50).alias("part"), "value") \
        .write.partitionBy("part").text(f"{base}/in")
    q = streams.filter_sitemaps_stream(spark, f"{base}/in", f"{base}/out", f"{base}/ckpt",
                                       geo.sample_dimension(spark), suffix=".txt")
    q.awaitTermination()
    return spark.read.schema("value string, out_group string, out_key string").text(f"{base}/out")


QUERIES["stream_equals_batch"] = q_stream_equals_batch


# --- the flagship over a corpus that grows with lineitem ------------------------------

def q_sitemap_country_counts_lineitem(spark, sf_dir):
    """Flagship pipeline over one robots capture per lineitem row."""
    keys = corpus.lineitem_pages(table(spark, sf_dir, "lineitem"))
    caps = corpus.robots_captures(keys)
    links = robots.sitemap_rows(robots.with_sitemaps(caps), ["page_id", "robots_host"]).drop("sitemap_no")
    cls = geo.classify(links, geo.sample_dimension(spark), "robots_host", "sitemap_url")
    return cls.groupBy("country_key", "language_region").agg(F.count(F.lit(1)).alias("links"))


QUERIES["sitemap_country_counts_lineitem"] = q_sitemap_country_counts_lineitem


# --- local robots tree round trip ------------------------------------------------------


def q_local_tree_roundtrip(spark, sf_dir):
    """Corpus A exported as one file per capture (``<host>/<scheme>-<id>.txt``),
    read back as a local robots tree (recursive binaryFile scan), parsed;
    one row per distinct sitemap link (the local-sitemaps job rows)."""
    c = captures(spark, sf_dir)
    scheme = F.regexp_extract("robots_url", "^([a-z]+)://", 1)
    files = c.select(F.concat("robots_host", F.lit("/"), scheme, F.lit("-"), F.col("page_id").cast("string"),
                              F.lit(".txt")).alias("file_name"), F.col("body").alias("text"))
    root = f"{checkpoint_dir(spark).rstrip('/')}/robots-tree-{uuid.uuid4().hex}"
    robots_files.export_files(files, root)
    tree = local_tree.read_robots_tree(spark, root).withColumn("text", robots.decode_body("body")).drop("body")
    parsed_tree = robots.with_sitemaps(tree, body="text")
    rows = parsed_tree.filter(F.col("robots.valid")).select(
        "robots_host", "robots_scheme",
        F.element_at(F.split("robots_file_path", "/"), -1).alias("file_name"),
        F.explode(F.array_distinct("robots.sitemaps")).alias("sitemap_url"))
    return rows


QUERIES["local_tree_roundtrip"] = q_local_tree_roundtrip


# --- classification with a dimension loaded from a suffix file ----------------------------

# The sample rows as a suffix file would hold them (raw IDN
# suffixes, one malformed row, one row with an empty field).
SUFFIX_FILE_LINES = [
    "country_key\tcountry_name\tsuffix", "france\tFrance\t.fr", "germany\tGermany\tde",
    "russian-federation\tRussian Federation\t.ru", "russian-federation\tRussian Federation\t.рф",
    "ukraine\tUkraine\t.ua", "ukraine\tUkraine\t.укр", "broken row", "united-kingdom\tUnited Kingdom\t.gb",
    "nowhere\t\t.zz", "united-kingdom\tUnited Kingdom\t.UK",
]


def q_sitemaps_classified_loaded_dim(spark, sf_dir):
    path = f"{checkpoint_dir(spark).rstrip('/')}/suffixes-{uuid.uuid4().hex}.tsv"
    with open_output(path) as f:
        f.write(("\n".join(SUFFIX_FILE_LINES) + "\n").encode("utf-8"))
    dim = geo.load_suffixes(spark, path)
    return classified(spark, sf_dir, dim).select(
        "page_id", "robots_host", "sitemap_url", "country_key", "country_name", "matched_suffix",
        "language_region")


QUERIES["sitemaps_classified_loaded_dim"] = q_sitemaps_classified_loaded_dim


# --- robots parsing over real text -------------------------------------------------------


def documents_as_robots(spark, sf_dir) -> DataFrame:
    """Every whole text of ``documents`` as a robots body."""
    return table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("body"))


def q_robots_directives_text(spark, sf_dir):
    return robots.directive_rows(documents_as_robots(spark, sf_dir), ["doc_id"])


def q_robots_warnings_text(spark, sf_dir):
    return robots.warning_rows(robots.with_robots(documents_as_robots(spark, sf_dir)), ["doc_id"])


def q_robots_groups_for_agent_table(spark, sf_dir):
    """Agent names come from a table."""
    agents = table(spark, sf_dir, "nation").select(F.col("n_name").alias("agent"))
    return robots.agent_group_rows_from(parsed(spark, sf_dir), ["page_id"], agents)


def q_robots_quality_report(spark, sf_dir):
    """Warnings per country ending of corpus A, merged from sketches per archive, beside exact checks:
    is the median number of warnings per file, and the number of distinct messages, within its bound?"""
    label = F.substring_index("robots_host", ".", -1)
    p = (parsed(spark, sf_dir).withColumn("archive_path", F.floor(F.col("page_id") / 10).cast("string")).withColumn("ending", label))
    by = ["archive_path", "ending"]
    files = quality.merged_files(quality.file_sketches(p, by), ["ending"])
    kinds = quality.merged_kinds(quality.kind_sketches(p, by), ["ending"])
    report = quality.file_report(files, {"median": 0.5})
    n = F.size("robots.warnings")
    # One row per ending from here on the right side: exact ranks of the estimate, and exact distinct messages.
    rank = (p.select("ending", n.alias("n")).join(report.select("ending", "median"), "ending").groupBy("ending")
            .agg((F.count_if(F.col("n") < F.col("median")) / F.count(F.lit(1))).alias("below"),
                 (F.count_if(F.col("n") <= F.col("median")) / F.count(F.lit(1))).alias("upto")))
    slack = 5 * quality.RANK_ERROR
    exact = (p.select("ending", F.explode("robots.warnings.message").alias("message")).distinct()
             .groupBy("ending", quality.warning_kind(F.col("message")).alias("kind")).agg(F.count(F.lit(1)).alias("distinct_exact")))
    close = F.abs(F.col("distinct_messages") - F.col("distinct_exact")) <= 1 + 5 * quality.DISTINCT_ERROR * F.col("distinct_exact")
    per_kind = (quality.kind_report(kinds).join(exact, ["ending", "kind"])
                .select("ending", "kind", "warnings", close.alias("in_bound")))
    per_file = (report.join(rank, "ending").select(
        "ending", F.lit("any").alias("kind"), "warnings",
        ((F.col("below") - slack <= 0.5) & (F.lit(0.5) <= F.col("upto") + slack)).alias("in_bound"), "files", "rejected_files"))
    return per_file.unionByName(per_kind, allowMissingColumns=True)


def q_resolve_long(spark, sf_dir):
    """References as long as a page: its whole html as a path and as a query."""
    pages = table(spark, sf_dir, "pages")
    plain = F.regexp_replace("html", "[^A-Za-z0-9]+", "-")
    refs = F.array(F.concat(F.lit("/"), plain), F.concat(F.lit("/p?"), plain, F.lit("=%41"), plain),
                   F.concat(F.lit("/d/../"), plain, F.lit("/./")))
    x = pages.select("page_id", F.col("url").alias("base"), F.posexplode(refs).alias("ref_no", "ref"))
    return with_resolved(x, "base", "ref", "resolved").select(
        "page_id", F.col("ref_no").cast("long").alias("ref_no"), F.sha2("resolved", 256).alias("resolved_sha256"))


# --- jobs, run as they are used: written, run again, read back -----------------------------


def _archived(spark, rows: DataFrame, out_dir: str) -> str:
    """Write (archive_key, target_url, capture_date, body, content_encoding) rows as archives."""
    warc.write_warc_files(rows, out_dir).write.format("noop").mode("overwrite").save()
    return out_dir


def _capture_rows(spark, sf_dir) -> DataFrame:
    key = F.floor(F.col("page_id") / 10).cast("long")
    return captures(spark, sf_dir).select(
        "page_id", key.alias("key"), key.cast("string").alias("archive_key"), F.col("robots_url").alias("target_url"),
        corpus.capture_date().alias("capture_date"), "body", F.lit("gzip").alias("content_encoding"))


def q_robots_job_rerun(spark, sf_dir):
    """Odd archives, then even ones, then the odd ones again: the table holds every valid capture once."""
    base, rows = work_folder(spark, "robots-job"), _capture_rows(spark, sf_dir)
    odd = _archived(spark, rows.where("key % 2 = 1"), f"{base}/odd")
    even = _archived(spark, rows.where("key % 2 = 0"), f"{base}/even")
    for src in (odd, even, odd):
        jobs.robots_job(spark, src, f"{base}/table")
    return robots_files.read_by_archive(spark, f"{base}/table").select("target_url", "capture_date", F.col("text").alias("body"))


def q_sitemaps_job_rerun(spark, sf_dir):
    """All archives, then again with html in the odd ones: those have no links any more."""
    base, rows = work_folder(spark, "sitemaps-job"), _capture_rows(spark, sf_dir)
    jobs.sitemaps_job(spark, _archived(spark, rows, f"{base}/in"), f"{base}/out")
    changed = rows.withColumn("body", F.when(F.col("key") % 2 == 1, "<html></html>").otherwise(F.col("body")))
    jobs.sitemaps_job(spark, _archived(spark, changed, f"{base}/in"), f"{base}/out")
    f = F.split("value", "\t")
    return robots_files.read_by_archive(spark, f"{base}/out", "text").select(f[1].alias("capture_date"), f[2].alias("robots_url"), f[3].alias("sitemap_url"))


def q_filter_job_rerun(spark, sf_dir):
    """All link rows, then those of even pages: groups of the first run are gone."""
    base, lines = work_folder(spark, "filter-job"), local_sitemap_lines(spark, sf_dir)
    for part, some in (("all", lines), ("even", lines.where("page_id % 2 = 0"))):
        some.select("value").write.text(f"{base}/{part}")
        jobs.filter_sitemaps_job(spark, f"{base}/{part}", f"{base}/out", geo.sample_dimension(spark), suffix=".txt")
    return tsv_sink.read_grouped(spark, f"{base}/out")


def q_snapshot_jobs(spark, sf_dir):
    """Link and group tables as snapshots: what a reader of the first run still sees after the second
    one (``before``), and what the newest version holds (``after``)."""
    base, rows = work_folder(spark, "snapshot-jobs"), _capture_rows(spark, sf_dir)
    jobs.sitemaps_job(spark, _archived(spark, rows, f"{base}/in"), f"{base}/out", snapshots=True)
    before = snapshots.read(spark, f"{base}/out")
    changed = rows.withColumn("body", F.when(F.col("key") % 2 == 1, "<html></html>").otherwise(F.col("body")))
    jobs.sitemaps_job(spark, _archived(spark, changed, f"{base}/in"), f"{base}/out", snapshots=True)
    jobs.filter_sitemaps_job(spark, _local_lines_table(spark, sf_dir, base), f"{base}/groups", geo.sample_dimension(spark), snapshots=True)
    f = F.split("value", "\t")

    def links(df, state):
        return df.select(F.lit(state).alias("state"), f[2].alias("a"), f[3].alias("b"))

    groups = tsv_sink.read_grouped(spark, f"{base}/groups").select(F.lit("group").alias("state"), F.col("out_group").alias("a"), F.col("out_key").alias("b"))
    return links(before, "before").unionByName(links(snapshots.read(spark, f"{base}/out"), "after")).unionByName(groups)


def _local_lines_table(spark, sf_dir, base: str) -> str:
    """Local link lines as a snapshot table of two commits, by part of the pages."""
    table = snapshots.SnapshotTable(spark, f"{base}/lines", ["part"], "text")
    lines = local_sitemap_lines(spark, sf_dir).select("value", (F.col("page_id") % 4).cast("string").alias("part"))
    table.replace(lines)
    table.replace(lines.where("part = '1'"), lines.select("part").where("part IN ('1', '2')"))
    return f"{base}/lines"


def q_manifest_sitemaps_job(spark, sf_dir):
    """A manifest of ``file:`` archives -> staged -> link rows that carry the manifest's paths."""
    base = work_folder(spark, "manifest-job")
    written = warc.write_warc_files(_capture_rows(spark, sf_dir), f"{base}/robotstxt")
    path = F.when(F.col("archive_path").contains(":"), F.col("archive_path")).otherwise(F.concat(F.lit("file://"), "archive_path"))
    written.select(path.alias("value")).write.option("compression", "gzip").text(f"{base}/manifest")
    staged = jobs.stage_archives(spark, f"{base}/manifest", f"{base}/staged")
    jobs.sitemaps_job(spark, staged, f"{base}/out")
    f = F.split("value", "\t")
    return robots_files.read_by_archive(spark, f"{base}/out", "text").select(
        F.regexp_extract(f[0], "/robotstxt/([0-9]+)-[0-9]+[.]warc[.]gz$", 1).alias("archive_key"),
        f[1].alias("capture_date"), f[2].alias("robots_url"), f[3].alias("sitemap_url"))


def q_job_failures(spark, sf_dir):
    """One capture per order, every tenth with a body that is not what its header says: all are listed."""
    base = work_folder(spark, "job-failures")
    key = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(
        F.floor(key / 4000).cast("string").alias("archive_key"),
        F.concat(F.lit("https://o"), key.cast("string"), F.lit(".example.ua/robots.txt")).alias("target_url"),
        F.lit("2024-08-01T00:00:00Z").alias("capture_date"), F.lit("Sitemap: /s.xml\n").alias("body"),
        F.when(key % 10 == 0, "!gzip").otherwise("gzip").alias("content_encoding"))
    try:
        jobs.sitemaps_job(spark, _archived(spark, rows, f"{base}/in"), f"{base}/out")
    except jobs.JobFailed:
        pass  # the job has finished all other work and says where it lists what failed
    listed = spark.read.text(f"{base}/out-failures").select(
        F.regexp_extract("value", "(https://o[0-9]+[.]example[.]ua/robots[.]txt): Body decode failed", 1).alias("robots_url"),
        F.lit("failed").alias("outcome"))
    links = robots_files.read_by_archive(spark, f"{base}/out", "text").select(F.split("value", "\t")[2].alias("robots_url"), F.lit("link").alias("outcome"))
    return listed.unionByName(links)


def q_fetch_rows(spark, sf_dir):
    """One file per page, fetched by ``file:`` URL, with a missing file and a foreign scheme per page."""
    base = work_folder(spark, "fetch")
    pages = table(spark, sf_dir, "pages").select("page_id", "html")
    name = F.concat(F.col("page_id").cast("string"), F.lit(".html"))
    robots_files.export_files(pages.select(name.alias("file_name"), F.col("html").alias("text")), f"{base}/files")
    root = F.lit(f"{base}/files/" if ":" in base else f"file://{base}/files/")
    urls = pages.select(F.explode(F.array(F.concat(root, name), F.concat(root, F.lit("no-"), name),
                                          F.concat(F.lit("gopher://x/"), name))).alias("url"))
    got = fetch.fetch(urls, delay=0)
    return got.select(F.regexp_extract("url", "([^/]*)$", 1).alias("name"),
                      F.regexp_extract("url", "^([a-z]+):", 1).alias("scheme"), F.col("status").cast("long").alias("status"),
                      F.length("body").cast("long").alias("n_bytes"), F.col("attempts").cast("long").alias("attempts"),
                      F.regexp_extract("error", "^([A-Za-z ]+)", 1).alias("problem"))


QUERIES.update({
    "robots_directives_text": q_robots_directives_text,
    "robots_warnings_text": q_robots_warnings_text,
    "robots_groups_for_agent_table": q_robots_groups_for_agent_table,
    "robots_quality_report": q_robots_quality_report,
    "resolve_long": q_resolve_long,
    "robots_job_rerun": q_robots_job_rerun,
    "sitemaps_job_rerun": q_sitemaps_job_rerun,
    "snapshot_jobs": q_snapshot_jobs,
    "filter_job_rerun": q_filter_job_rerun,
    "manifest_sitemaps_job": q_manifest_sitemaps_job,
    "job_failures": q_job_failures,
    "fetch_rows": q_fetch_rows,
})


def q_country_sitemaps_job(spark, sf_dir):
    base = work_folder(spark, "country-job")
    src = _archived(spark, _capture_rows(spark, sf_dir), f"{base}/in")
    jobs.country_sitemaps_job(spark, src, f"{base}/out", "Ukraine", geo.sample_dimension(spark))
    f = F.split("value", "\t")
    return spark.read.text(f"{base}/out").select(*[f[i + 1].alias(c) for i, c in enumerate(tsv.WARC_COUNTRY_COLUMNS[1:])])


def q_local_country_job(spark, sf_dir):
    base = work_folder(spark, "local-country-job")
    local_sitemap_lines(spark, sf_dir).select("value").write.text(f"{base}/in")
    jobs.local_country_sitemaps_job(spark, f"{base}/in", f"{base}/out", "ua", geo.sample_dimension(spark), suffix=".txt")
    return spark.read.text(f"{base}/out")


def link_lines(spark, sf_dir, *more: str) -> DataFrame:
    """Link TSV lines of the pages, every fifth without its page URL, with further columns of the pages."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    url = F.when(F.col("page_id") % 5 == 4, F.lit("")).otherwise(F.col("url"))
    return pages.select(tsv_row(F.lit("https://s.example.ua/seed.xml"), F.lit("https://s.example.ua/map.xml"), url).alias("value"), *more)


def q_publish_stream(spark, sf_dir):
    """New link files -> the streaming publisher (available-now) -> its records read back."""
    base = work_folder(spark, "publish")
    link_lines(spark, sf_dir).write.text(f"{base}/in")
    streams.publish_urls_stream(spark, f"{base}/in", f"{base}/ckpt", f"{base}/out", suffix=".txt").awaitTermination()
    return spark.read.text(f"{base}/out")


def q_manifest_stream(spark, sf_dir):
    """Archives named by a manifest that grows between two runs of the stream -> grouped links."""
    base = work_folder(spark, "manifest-stream")
    names = (warc.write_warc_files(_capture_rows(spark, sf_dir), f"{base}/robotstxt").select("archive_path").distinct()
             .orderBy("archive_path").toPandas().archive_path.tolist())  # one name per archive
    for n in (len(names) // 2, len(names)):
        with open_output(f"{base}/paths") as f:
            f.write("".join(f"{name}\n" for name in ["# archives", *names[:n]]).encode("utf-8"))
        streams.archive_links_stream(spark, f"{base}/paths", f"{base}/out", f"{base}/ckpt", geo.sample_dimension(spark)).awaitTermination()
    f = F.split("value", "\t")
    return (spark.read.schema("value string, out_group string, out_key string").text(f"{base}/out")
            .select("out_group", "out_key", f[1].alias("capture_date"), f[2].alias("robots_url"), f[3].alias("sitemap_url")))


def q_publish_once_stream(spark, sf_dir):
    """Link files of even pages, then of all pages after a restart: each URL is published once."""
    base = work_folder(spark, "publish-once")
    rows = link_lines(spark, sf_dir, "page_id")
    for some in ("page_id % 2 = 0", "true"):
        rows.where(some).select("value").write.mode("append").text(f"{base}/in")
        streams.publish_urls_stream(spark, f"{base}/in", f"{base}/ckpt", f"{base}/out", suffix=".txt", once_within="30 days").awaitTermination()
    return spark.read.text(f"{base}/out")


def q_publish_ledger(spark, sf_dir):
    """A publishing stream whose target breaks in every task after its first chunk, run again until it is
    through: what the target got, and the ledger's counters."""
    base = work_folder(spark, "publish-ledger")
    link_lines(spark, sf_dir).write.text(f"{base}/in")
    book = Ledger(spark, f"{base}/ledger", chunk=100)
    whole = file_target(f"{base}/sent")

    def breaking():
        send, left = whole(), [1]

        def limited(values):
            if not left:
                raise ConnectionError("target lost")
            left.pop()
            send(values)

        return limited

    for target in (breaking, whole):
        try:
            streams.publish_with_ledger_stream(spark, f"{base}/in", f"{base}/ckpt", book, target, suffix=".txt").awaitTermination()
        except StreamingQueryException:
            pass
    counters = spark.createDataFrame([(f"{k}={v}",) for k, v in book.totals().items()], "value string")
    return spark.read.text(f"{base}/sent").unionByName(counters)


def q_job_counters(spark, sf_dir):
    """Counters that the filter and publish jobs report, one row each."""
    base = work_folder(spark, "counters")
    links = robots.sitemap_rows(parsed(spark, sf_dir), ["page_id", "robots_host"])
    tsv_lines_from_links(links).select("value").write.text(f"{base}/rows")
    link_lines(spark, sf_dir).write.text(f"{base}/links")
    done = {"filter": jobs.filter_sitemaps_job(spark, f"{base}/rows", f"{base}/kept", geo.sample_dimension(spark), suffix=".txt"),
            "publish": jobs.publish_urls_job(spark, f"{base}/links", f"{base}/sent", suffix=".txt")}
    rows = [(job, k, int(v)) for job, r in done.items() for k, v in r.metrics.items() if k != "files"]
    return spark.createDataFrame(rows, "job string, counter string, value long")


def q_country_archive_counts(spark, sf_dir):
    """The one-country job over the archives of a ``wat.paths.gz`` manifest: its counters per archive and in total."""
    base = work_folder(spark, "country-counts")
    written = warc.write_warc_files(_capture_rows(spark, sf_dir), f"{base}/robotstxt")
    path = F.when(F.col("archive_path").contains(":"), F.col("archive_path")).otherwise(F.concat(F.lit("file://"), "archive_path"))
    written.select(path.alias("value")).write.option("compression", "gzip").text(f"{base}/robotstxt.paths.gz")
    staged = jobs.stage_archives(spark, f"{base}/wat.paths.gz", f"{base}/staged")
    done = jobs.country_sitemaps_job(spark, staged, f"{base}/out", "ukraine", geo.sample_dimension(spark))
    unit = F.regexp_extract("archive_path", "/robotstxt/([0-9]+)-[0-9]+[.]warc[.]gz$", 1)
    total = spark.createDataFrame([("total", *(int(done.metrics[k]) for k in ("parsed_files", "rejected_files", "matched_links")))],
                                  "unit string, parsed_files long, rejected_files long, matched_links long")
    return done.per_unit.select(unit.alias("unit"), "parsed_files", "rejected_files", "matched_links", "sitemap_links").unionByName(
        total, allowMissingColumns=True)


def q_local_download_jobs(spark, sf_dir):
    """A local robots tree through the local job, and link rows with malformed ones through the download job:
    lines of both outputs and their counters."""
    base = work_folder(spark, "local-jobs")
    scheme = F.regexp_extract("robots_url", "^([a-z]+)://", 1)
    files = captures(spark, sf_dir).select(F.concat("robots_host", F.lit("/"), scheme, F.lit("-"), F.col("page_id").cast("string"),
                                                    F.lit(".txt")).alias("file_name"), F.col("body").alias("text"))
    robots_files.export_files(files, f"{base}/tree")
    local = jobs.local_sitemaps_job(spark, f"{base}/tree", f"{base}/local")
    seeds = corpus.sitemap_seeds(table(spark, sf_dir, "pages").select("page_id", "url"))
    line = F.when(F.col("seed_id") % 7 == 6, F.lit("one\ttwo\tthree")).otherwise(
        tsv_row(F.lit("archive"), F.lit("date"), F.lit("robots"), "seed_sitemap_url"))
    snapshots.SnapshotTable(spark, f"{base}/seeds", ["part"], "text").replace(
        seeds.select(line.alias("value"), (F.col("seed_id") % 3).cast("string").alias("part")))
    fetcher = crawl_op.table_fetcher(documents_b(spark, sf_dir))
    done = jobs.download_sitemaps_job(spark, f"{base}/seeds", f"{base}/links", fetcher=fetcher)
    f = F.split("value", "\t")
    rows = spark.read.text(f"{base}/local").select(F.lit("local").alias("output"), F.array_join(F.slice(f, 2, 3), " ").alias("line"))
    links = spark.read.text(f"{base}/links").select(F.lit("download").alias("output"), F.array_join(f, " ").alias("line"))
    counters = spark.createDataFrame([(job, f"{k}={int(v)}") for job, r in (("local counter", local), ("download counter", done))
                                      for k, v in r.metrics.items()], "output string, line string")
    return rows.unionByName(links).unionByName(counters)


def q_packed_sitemap_docs(spark, sf_dir):
    """Corpus B with the documents of odd pages packed by gzip, and an entity declaration before those of every ninth."""
    @F.pandas_udf("binary")
    def packed(bodies):
        return bodies.map(lambda b: gzip.compress(b.encode("utf-8"), mtime=0))

    page = F.regexp_extract("url", "-([0-9]+)[.]xml$", 1).cast("long")
    entity = F.lit('<!DOCTYPE x [<!ENTITY a "b">]>')
    docs = documents_b(spark, sf_dir).withColumn("page_id", page).withColumn(
        "body", F.when((page % 9 == 0) & F.col("body").startswith("<") & ~F.col("body").startswith("<?"), F.concat(entity, "body"))
        .otherwise(F.col("body")))
    d = parse_sitemaps(docs.select("url", F.when(page % 2 == 1, packed("body")).otherwise(F.encode("body", "UTF-8")).alias("body")))
    return d.select("url", F.col("doc.kind").alias("kind"), F.array_join("doc.locs", " ").alias("locs"), F.col("doc.error").alias("error"))


def q_root_zone_dimension(spark, sf_dir):
    """A suffix dimension refreshed from root-zone pages (one index page per region, one detail page per nation),
    and the supported keys that an error would list."""
    n = table(spark, sf_dir, "nation").select(F.col("n_regionkey").alias("region"), F.col("n_nationkey").cast("string").alias("no"), "n_name")
    href = F.concat(F.lit("/domains/root/db/n"), "no", F.lit(".html"))
    row = F.concat(F.lit('<tr><td><span class="domain tld"><a href="'), href, F.lit('">.n'), "no", F.lit("</a></span></td>\n<td>"),
                   F.when(F.col("no") % 5 == 0, F.lit("generic")).otherwise(F.lit("country&#45;code")), F.lit("</td></tr>"))
    index = n.groupBy("region").agg(F.array_join(F.collect_list(row), "\n").alias("html"))
    details = n.select(href.alias("href"), F.concat(
        F.lit("<p><!-- (Country-code top-level domain designated for "), F.replace("n_name", F.lit(" "), F.lit("&#32;")), F.lit(") --></p>")).alias("html"))
    dim = html_fn.suffixes_from_root_zone_pages(index, details)
    keys = geo.supported_country_keys(dim).select(F.lit("supported").alias("part"), "country_key")
    return dim.select(F.lit("dimension").alias("part"), "*").unionByName(keys, allowMissingColumns=True)


QUERIES.update({
    "country_archive_counts": q_country_archive_counts,
    "local_download_jobs": q_local_download_jobs,
    "packed_sitemap_docs": q_packed_sitemap_docs,
    "root_zone_dimension": q_root_zone_dimension,
    "country_sitemaps_job": q_country_sitemaps_job,
    "local_country_job": q_local_country_job,
    "publish_stream": q_publish_stream,
    "manifest_stream": q_manifest_stream,
    "publish_once_stream": q_publish_once_stream,
    "publish_ledger": q_publish_ledger,
    "job_counters": q_job_counters,
})
