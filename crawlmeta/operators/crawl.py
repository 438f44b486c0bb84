"""Sitemap-index crawl: every URL that a seed reaches, with its least depth.

Per seed URL the walk starts at depth 0; every fetched document is parsed;
a URL set emits its resolved page URLs, an index enqueues its resolved
children at depth + 1. A URL is processed once per seed, and depth <=
``max_depth`` (21 levels for the default 20). The first visit of a
breadth-first walk has the least depth, so any way to compute least depths
gives the walk's visits.

A fetcher turns a set of URLs into row sets: ``status (url, kind, error)``,
``index_edges (url, target)`` (resolved children of sitemap indexes) and
``page_edges (url, target)`` (resolved page URLs of URL sets, duplicates kept).
Every URL is fetched and parsed once per crawl, not once per seed or level.

* When all documents are a table (``table_fetcher``), every link is known before
  the walk: ``reach.least_depths`` doubles the links and needs six joins for
  depth 20 instead of a job per level.
* When links are learnt by fetching (``body_fetcher``), each level joins its
  frontier with the index edges and keeps what ``visited.Visited`` has not seen:
  a broadcast anti join while the visited set is small, later a Bloom filter
  probe and an anti join of its hits with a bucketed table, so that a level
  shuffles its candidates alone.

Two joins finish the job: visits = least depths JOIN status, links = URL-set
visits JOIN page_edges. The page edges are by far the largest; they are made from
the parsed documents in that last join and never written or scanned per level.

Scale notes: joins with a seed that has millions of children are skewed, and
adaptive execution splits them. Sides are broadcast only by counted bytes
(BROADCAST_BYTES), else both sides are sorted and merged, which can spill. Tables
between rounds are Parquet in the cluster's checkpoint folder, so a lost executor
recomputes at most one round. Distinct seed URLs are crawled once and seed rows
join their results back (a seed listed twice emits its links twice).
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlmeta.functions.resolve import with_resolved
from crawlmeta.operators.reach import least_depths, sized
from crawlmeta.operators.sitemap_docs import KIND_FAILED, KIND_INDEX, KIND_INVALID, KIND_URLSET
from crawlmeta.operators.sitemap_rows import location_rows
from crawlmeta.operators.visited import Visited
from crawlmeta.session import work_folder

MAX_SITEMAP_INDEX_DEPTH = 20
# A frontier / visited set is broadcast up to this many bytes of its strings,
# counted when it is written (never an optimizer estimate).
BROADCAST_BYTES = 32 << 20

# Sitemap bodies can be tens of MB: keep Arrow batches to few documents.
DOCUMENT_BATCH_ROWS = 256


@contextmanager
def small_arrow_batches(spark, rows: int = DOCUMENT_BATCH_ROWS):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key, None)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)

STATUS_PARSED, STATUS_INVALID, STATUS_FAILED = "parsed", "invalid", "failed"


@dataclass
class CrawlResult:
    links: DataFrame      # seed_id, seed_sitemap_url, sitemap_url, page_url
    visits: DataFrame     # seed_id, seed_sitemap_url, sitemap_url, depth, status, error


@dataclass
class Fetched:
    status: DataFrame        # url, kind, error       (one row per fetched URL)
    index_edges: DataFrame   # url, target            (children of sitemap indexes)
    page_edges: DataFrame    # url, target            (page URLs of URL sets)


def documents_to_fetched(docs: DataFrame) -> Fetched:
    """(url, body) -> parsed status + resolved edges. One pass parses the
    bodies into a table of URL rows; the children of indexes are a second, small
    table."""
    spark = docs.sparkSession
    folder = work_folder(spark, "documents")
    with small_arrow_batches(spark):
        rows = _table(location_rows(docs), f"{folder}/rows")

    def edges(kind: str) -> DataFrame:
        locs = rows.where((F.col("kind") == kind) & (F.col("loc_no") > 0)).select("url", "loc")
        return with_resolved(locs, "url", "loc", "target").where("target IS NOT NULL").select("url", "target")

    status = rows.where("loc_no = 0").select("url", "kind", "error")
    return Fetched(status, _table(edges(KIND_INDEX), f"{folder}/index_edges"), edges(KIND_URLSET))


def _union_fetched(a: Fetched, b: Fetched) -> Fetched:
    return Fetched(a.status.unionByName(b.status), a.index_edges.unionByName(b.index_edges),
                   a.page_edges.unionByName(b.page_edges))


def table_fetcher(documents: DataFrame, url: str = "url", body: str = "body") -> Callable[[DataFrame], Fetched]:
    """Fetch = lookup in a table of downloaded bodies. The whole table is
    parsed and resolved once (lazily, at the first level); a URL missing
    from it is a failed download."""
    cache: dict[str, Fetched] = {}

    def fetch(urls: DataFrame) -> Fetched:
        if "all" not in cache:
            cache["all"] = documents_to_fetched(documents.select(F.col(url).alias("url"), F.col(body).alias("body")))
        return cache["all"]

    fetch.knows_all = True  # every link is known before the walk
    return fetch


def body_fetcher(fetch_bodies: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], Fetched]:
    """Wrap a fetcher returning ``(url, body)`` (NULL body = failed): each
    level downloads only URLs no earlier level fetched, then parses and
    resolves them; results accumulate for later levels. A URL reached from
    several seeds is downloaded once per crawl (the per-seed walk reuses
    the result), not once per seed."""
    known: list[Fetched] = []

    def fetch(urls: DataFrame) -> Fetched:
        new = urls
        if known:
            new = urls.join(known[0].status.select("url"), "url", "left_anti")
        got = documents_to_fetched(fetch_bodies(new))
        if known:
            got = _union_fetched(known[0], got)
        known[:] = [got]
        return got
    return fetch


def _walked(roots: DataFrame, fetch: Callable[[DataFrame], Fetched], max_depth: int, folder: str) -> tuple[DataFrame, int, Fetched | None]:
    """Level by level, for fetchers that learn links only by fetching."""
    seen = Visited(roots.sparkSession, folder, BROADCAST_BYTES)
    frontier, n_frontier, n_bytes = seen.add(roots.select("root", F.col("root").alias("url")), 0)
    got: Fetched | None = None
    for depth in range(max_depth + 1):
        if n_frontier == 0:
            break
        got = fetch(frontier.select("url").distinct())
        if depth == max_depth:
            break
        children = (_sized(frontier, n_bytes).join(got.index_edges, "url")
                    .select("root", F.col("target").alias("url")))
        frontier, n_frontier, n_bytes = seen.add(seen.unseen(children), depth + 1)
    seen.close()
    return seen.all(), seen.bytes, got


def crawl(seeds: DataFrame, fetch: Callable[[DataFrame], Fetched], max_depth: int = MAX_SITEMAP_INDEX_DEPTH,
          seed_id: str = "seed_id", seed_url: str = "seed_sitemap_url") -> CrawlResult:
    if max_depth < 0:
        raise ValueError("max_depth must be >= 0")
    spark = seeds.sparkSession
    folder = work_folder(spark, "crawl")
    roots = seeds.select(F.col(seed_url).alias("root")).distinct()
    status_expr = (F.when(F.col("kind").isin(KIND_URLSET, KIND_INDEX), STATUS_PARSED)
                   .when(F.col("kind") == KIND_INVALID, STATUS_INVALID).otherwise(STATUS_FAILED))
    if getattr(fetch, "knows_all", False):
        got: Fetched | None = fetch(roots)
        visited, visited_bytes = least_depths(roots, got.index_edges, max_depth, folder, BROADCAST_BYTES)
    else:
        visited, visited_bytes, got = _walked(roots, fetch, max_depth, folder)
    schema_v = "root string, sitemap_url string, depth int, status string, error string"
    if got is None:
        all_visits = spark.createDataFrame([], schema_v)
        all_links = spark.createDataFrame([], "root string, sitemap_url string, page_url string")
    else:
        f = _sized(visited, visited_bytes)
        v = f.join(got.status, "url", "left").select(
            "root", F.col("url").alias("sitemap_url"), "depth",
            F.coalesce("kind", F.lit(KIND_FAILED)).alias("kind"),
            F.coalesce("error", F.when(F.col("kind").isNull(), F.lit("Download failed"))).alias("error"))
        all_visits = v.select("root", "sitemap_url", "depth", status_expr.alias("status"), "error")
        urlsets = v.filter(F.col("kind") == KIND_URLSET).select("root", F.col("sitemap_url").alias("url"))
        all_links = urlsets.join(got.page_edges, "url").select(
            "root", F.col("url").alias("sitemap_url"), F.col("target").alias("page_url"))
    s = seeds.select(F.col(seed_id).alias("seed_id"), F.col(seed_url).alias("root"))
    out_links = s.join(all_links, "root").select(
        "seed_id", F.col("root").alias("seed_sitemap_url"), "sitemap_url", "page_url")
    out_visits = s.join(all_visits, "root").select(
        "seed_id", F.col("root").alias("seed_sitemap_url"), "sitemap_url", "depth", "status", "error")
    return CrawlResult(out_links, out_visits)


def _sized(df: DataFrame, size: int) -> DataFrame:
    return sized(df, size, BROADCAST_BYTES)


def _table(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def seed_counters(result: CrawlResult, seeds: DataFrame, seed_id: str = "seed_id") -> DataFrame:
    """Per seed row: downloaded (parsed), invalid, failed documents and saved links."""
    v = result.visits.groupBy("seed_id").agg(
        F.count_if(F.col("status") == STATUS_PARSED).cast("long").alias("downloaded_sitemaps"),
        F.count_if(F.col("status") == STATUS_INVALID).cast("long").alias("invalid_sitemaps"),
        F.count_if(F.col("status") == STATUS_FAILED).cast("long").alias("failed_downloads"))
    ln = result.links.groupBy("seed_id").agg(F.count(F.lit(1)).cast("long").alias("saved_links"))
    base = seeds.select(F.col(seed_id).alias("seed_id"))
    return (base.join(v, "seed_id", "left").join(ln, "seed_id", "left")
            .na.fill(0, ["downloaded_sitemaps", "invalid_sitemaps", "failed_downloads", "saved_links"]))
